"""Rows for score stores, review queues and incident records, and their writers."""

from pyspark.sql import functions as F

from guardlake.functions import preview
from guardlake.schemas import DEFAULT_THRESHOLD, DIMENSIONS, SCORE_FIELD, SCORE_PREFIX, dim_column


def score_fanout(df, trace_col, *, threshold_met_col=None, comment_col=None, explanations_col=None, ids=()):
    """One row per trace and score name: ``trace_id, name, value, comment`` and the ``ids`` columns.

    Names: the overall score, the confidence, whether the threshold was met (only
    where known) and each scored dimension.  The overall row carries the given
    comment, dimension rows their explanation (``MAP<dimension, text>``).
    """
    null = F.lit(None).cast("string")
    comment = F.col(comment_col) if comment_col else null

    def item(name, value, text=null):
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), text.alias("comment"))

    items = [item(SCORE_FIELD, F.col("score"), comment), item(f"{SCORE_PREFIX}confidence", F.col("confidence"))]
    if threshold_met_col:
        met = F.col(threshold_met_col)
        items.append(F.when(met.isNotNull(), item(f"{SCORE_PREFIX}threshold_met", met.cast("int"))))
    for d in DIMENSIONS:
        c = dim_column(d)
        if c in df.columns:
            why = F.try_element_at(F.col(explanations_col), F.lit(d)) if explanations_col else null
            items.append(F.when(F.col(c).isNotNull(), item(f"{SCORE_PREFIX}{d}", F.col(c), why)))
    rows = df.select(F.col(trace_col).alias("trace_id"), *ids, F.explode(F.array(*items)).alias("_item"))
    return rows.where(F.col("_item").isNotNull()).select("trace_id", *ids, "_item.*")


def review_items(
    df,
    key_col,
    content_col,
    *,
    ts_col="ts",
    threshold=DEFAULT_THRESHOLD,
    org="",
    project="",
    environment="production",
    incident_col=None,
    metadata_col=None,
    explanations_col=None,
):
    """One item per dimension strictly below the threshold.

    The item id is a hash of key and dimension, so a repeated run gives the same items.
    """
    scored = [d for d in DIMENSIONS if dim_column(d) in df.columns]
    low = [
        F.when(
            F.col(dim_column(d)) < threshold,
            F.struct(F.lit(d).alias("dimension"), F.col(dim_column(d)).alias("score")),
        )
        for d in scored
    ]
    extra = [c for c in (incident_col, metadata_col, explanations_col) if c]
    rows = df.select(*dict.fromkeys([key_col, content_col, ts_col, *extra]), F.explode(F.array(*low)).alias("_low"))
    rows = rows.where(F.col("_low").isNotNull())
    null = F.lit(None).cast("string")
    dimension = F.col("_low.dimension")
    item_id = F.concat(
        F.lit("rev_"), F.substring(F.sha2(F.concat_ws(":", F.col(key_col).cast("string"), dimension), 256), 1, 12)
    )
    return rows.select(
        item_id.alias("item_id"),
        F.col(key_col).alias("source_key"),
        dimension.alias("dimension"),
        F.col("_low.score").alias("score"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(org).alias("org_id"),
        F.lit(project).alias("project_id"),
        F.lit(environment).alias("environment"),
        F.col(ts_col).alias("enqueued_at"),
        preview(content_col, 200).alias("content_preview"),
        (F.try_element_at(F.col(explanations_col), dimension) if explanations_col else null).alias("explanation"),
        (F.col(incident_col) if incident_col else null).alias("incident_id"),
        (F.col(metadata_col) if metadata_col else F.create_map().cast("map<string,string>")).alias("metadata"),
    )


def queue_sizes(queue):
    """Pending items by dimension."""
    return queue.groupBy("dimension").agg(F.count(F.lit(1)).alias("items"))


def queue_size(queue):
    """Pending items in all, one row."""
    return queue.agg(F.count(F.lit(1)).alias("items"))


def pending(queue, dimension=None, *, drained_at=None):
    """Items not drained yet, of one dimension if given."""
    if drained_at is not None:
        queue = queue.where(F.col("enqueued_at") > _time(drained_at))
    return queue if dimension is None else queue.where(F.col("dimension") == dimension)


def drain(queue, upto, *, drained_at=None):
    """Items handed out by draining at ``upto``; keep ``upto`` as the next ``drained_at``.

    The queue table is append-only, so draining moves a mark and deletes nothing.
    """
    return pending(queue, drained_at=drained_at).where(F.col("enqueued_at") <= _time(upto))


def _time(value):
    return value if hasattr(value, "alias") else F.lit(value).cast("timestamp_ntz")


def incidents(
    df, *, id_col, type_col, severity_col, title_col, dimensions_col, threshold_col, ts_col="ts", metadata_col=None
):
    """Incident records with status ``open``; metadata fields follow in the JSON ``record``."""
    out = df.select(
        F.col(id_col).alias("incident_id"),
        F.col(type_col).alias("type"),
        F.col(severity_col).alias("severity"),
        F.lit("open").alias("status"),
        F.col(title_col).alias("title"),
        F.col(dimensions_col).alias("affected_dimensions"),
        F.col(threshold_col).cast("double").alias("threshold"),
        F.col(ts_col).alias("timestamp"),
        *([F.col(metadata_col).alias("metadata")] if metadata_col else []),
    )
    record = F.to_json(F.struct(*[c for c in out.columns if c != "metadata"]))
    if metadata_col:
        # Both are JSON objects: drop the closing brace of one, the opening of the other.
        joined = F.concat(F.regexp_replace(record, r"}$", ","), F.substring(F.to_json("metadata"), 2, 1 << 30))
        record = F.when(F.size("metadata") > 0, joined).otherwise(record)
    return out.withColumn("record", record)


def append_parquet(df, path, partition_by=()):
    """Append rows to a Parquet table."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_json(df, path):
    """Append rows to a JSON-lines table."""
    df.write.mode("append").json(path)


def append_lines(df, path, line_col="line"):
    """Append one text column as lines."""
    df.select(F.col(line_col).alias("value")).write.mode("append").text(path)
