"""Live trackers over streams.

Running figures are streaming aggregates, which combine rows before they are
shuffled, so a hot session does not burden one task.  Order-dependent rules with
state per key are in :mod:`guardlake.streaming.live`.
"""

from threading import Event

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from guardlake.operators.conversations import mode_rule
from guardlake.operators.regeneration import regeneration_sessions
from guardlake.schemas import CACHE_TTL_SECONDS, DEFAULT_THRESHOLD, REGENERATION_TTL_MINUTES
from guardlake.streaming.live import start_stateful


def stream_conversation_metrics(turns, key="conv_id", order="turn", *, threshold=DEFAULT_THRESHOLD, deep_every=5):
    """Running metrics per conversation and the depth its next turn needs (update or complete mode).

    Turns marked as not ``recorded``, input checks, do not count.
    """
    if "recorded" in turns.columns:
        turns = turns.where("recorded")
    out = turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("turn_count"),
        F.avg("score").alias("average_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.count_if(F.col("score") >= threshold).alias("passing"),
        F.count_if(F.col("score") < threshold).alias("below_threshold_count"),
        F.max_by("score", order).alias("last_score"),
    )
    return out.withColumn(
        "next_mode", mode_rule(F.col("turn_count") + 1, F.col("last_score"), None, deep_every, threshold)
    )


def stream_dedup(requests, key_cols, ts="ts", *, ttl_seconds=CACHE_TTL_SECONDS):
    """Requests that have to be sent, by Spark's own duplicate filter.

    Approximates the exact chain: a key is let through again only in a batch that
    starts after the watermark passed its first sighting by the time to live.
    :func:`~guardlake.streaming.live.stream_request_reuse` is exact.
    """
    return requests.withWatermark(ts, f"{int(ttl_seconds)} seconds").dropDuplicatesWithinWatermark(list(key_cols))


def stream_request_metrics(log, ts="ts", *, watermark="10 minutes", window="5 minutes"):
    """Requests, errors, credits and mean duration per endpoint and tumbling window; late rows are dropped."""
    return (
        log.withWatermark(ts, watermark)
        .groupBy(F.window(ts, window).alias("w"), "endpoint")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count("error_type").alias("errors"),
            F.sum("credits_consumed").alias("credits_consumed"),
            F.sum("duration_ms").alias("duration_total"),
        )
        .select(F.col("w.start").alias("window_start"), "endpoint", "requests", "errors", "credits_consumed", "duration_total")
    )


def write_batches(stream, path, checkpoint, *, transform=None, mode="append", observer=None, **trigger):
    """Write each micro-batch to its own ``batch_id`` partition of a Parquet table.

    A replayed batch overwrites its partition, so the sink is idempotent.
    ``transform`` turns the batch into the rows to store (review items, incidents,
    score fan-out); ``observer`` is called with the stored frame and the batch id.
    """

    def store(batch, batch_id):
        rows = transform(batch) if transform else batch
        target = f"{path}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(target)
        if observer:
            observer(batch.sparkSession.read.parquet(target), batch_id)

    options = trigger or {"availableNow": True}
    writer = stream.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**options)
    return start_stateful(stream.sparkSession, writer.start)


class ObservedBatches(StreamingQueryListener):
    """Hands the metrics of :func:`~guardlake.operators.policy.observe` on, micro-batch by micro-batch.

    ``on_batch(batch_id, counts)`` is called for every batch of a query that has
    metrics of that name, with a dict of them; ``totals`` adds them up.  ``ended``
    is set once a query of the name has stopped, after its last batch.
    """

    def __init__(self, name, on_batch=None):
        self.name, self.on_batch, self.totals, self.ended = name, on_batch, {}, Event()
        self._queries = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is None:
            return
        self._queries.add(progress.runId)
        counts = row.asDict()
        for k, v in counts.items():
            self.totals[k] = self.totals.get(k, 0) + (v or 0)
        if self.on_batch:
            self.on_batch(progress.batchId, counts)

    def onQueryTerminated(self, event):
        if event.runId in self._queries:
            self.ended.set()


def latest(spark, path, keys):
    """Current rows of a table written in update mode: the newest batch of each key wins."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in keys and c != "batch_id"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), "batch_id").alias("r")).select(*keys, "r.*")


def distinct_items(spark, path, id_col="item_id"):
    """Rows of an item table, one per id even if a source row came twice."""
    rows = spark.read.parquet(path).drop("batch_id")
    return rows.groupBy(id_col).agg(F.any_value(F.struct(*[c for c in rows.columns if c != id_col])).alias("r")).select(id_col, "r.*")


def stream_regeneration_sessions(steps, key="session_id", ts="ts", *, minutes=REGENERATION_TTL_MINUTES, watermark="1 minute"):
    """Live :func:`regeneration_sessions`, split by gaps in event time whatever the batches are.

    A session comes out once the watermark has passed its end.  Steps later than the
    watermark are left out and counted in the query's progress (``numRowsDroppedByWatermark``).
    """
    timed = steps.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return regeneration_sessions(timed, key, ts, minutes=minutes)
