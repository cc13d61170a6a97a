"""Streaming jobs over the event table, read as a file stream and run to its end."""

from pyspark.sql import functions as F

from guardlake.operators import dedup, policy, telemetry
from guardlake.plans import fixtures as fx
from guardlake.plans import queries as batch
from guardlake.schemas import CACHED_ENDPOINTS, DIM_COLUMNS, EVENTS
from guardlake.session import scratch_folder
from guardlake.sources import sinks
from guardlake.streaming import committed, live, pairs, trackers

#: Microseconds of 2024-12-31, the time of asking.
AS_OF_US = 1_735_603_200_000_000


#: Stretches of time the event table is written in, and so the batches a stream sees at least.
STRETCHES = 3


def event_stream(spark, sf, folder):
    """The whole event table as a stream of files, one stretch of time after the other."""
    return timed_stream(spark, fx.read(spark, sf, "events"), folder, EVENTS)


def timed_stream(spark, rows, folder, schema):
    """Rows with a time ``ts`` as a stream of files, one stretch of time after the other."""
    span = rows.select(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    for i in range(STRETCHES):
        part = rows
        if span.low is not None:
            step = (span.high - span.low) / STRETCHES
            late = F.lit(False) if i == STRETCHES - 1 else F.col("ts") >= F.lit(span.low + (i + 1) * step)
            part = rows.where(~late & ((F.col("ts") >= F.lit(span.low + i * step)) | F.lit(i == 0)))
        part.write.mode("append").parquet(f"{folder}/events")
    # A small stretch is one file; of a large one several files make a batch.
    files = max(1, rows.rdd.getNumPartitions())
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/events")


def _run(query):
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise error


def stream_session_metrics(spark, sf):
    """Running metrics and next depth per user, calls taken as turns."""
    folder = scratch_folder(spark, "session-metrics")
    turns = fx.calls_from_events(event_stream(spark, sf, folder)).withColumn("at", F.struct("ts", "call_id"))
    running = trackers.stream_conversation_metrics(turns, "session_id", "at")
    _run(trackers.write_batches(running, f"{folder}/out", f"{folder}/checkpoint", mode="update"))
    out = trackers.latest(spark, f"{folder}/out", ["session_id"])
    return out.withColumn("average_score", F.round("average_score", 8))


def _live_sessions(spark, sf, name):
    folder = scratch_folder(spark, name)
    day = 24 * 60
    sessions = live.stream_agent_sessions(
        fx.calls_from_events(event_stream(spark, sf, folder)),
        max_calls=40,
        ttl_minutes=20 * day,
        deep_every_n=7,
        base_mode="basic",
        forget_minutes=60 * day,
        as_of=AS_OF_US,
    )
    _run(trackers.write_batches(sessions, f"{folder}/out", f"{folder}/checkpoint"))
    return f"{folder}/out"


def stream_agent_sessions(spark, sf):
    """Depth and acceptance of every call, live."""
    out = live.session_calls(spark, _live_sessions(spark, sf, "agent-sessions"))
    return out.select("call_id", "accepted", "reject_reason", "mode")


def stream_agent_patterns(spark, sf):
    """Patterns of every session over its accepted calls, live."""
    out = live.session_summaries(spark, _live_sessions(spark, sf, "agent-patterns"))
    return out.select("session_id", F.inline("patterns"))


def stream_agent_summaries(spark, sf):
    """Figures of every session over its accepted calls, live."""
    out = live.session_summaries(spark, _live_sessions(spark, sf, "agent-summaries"))
    return out.select("session_id", "status", "closed_at", "total_tool_calls", "risk_trend", F.round("total_credits", 6).alias("total_credits"))


def stream_observed_policy(spark, sf):
    """Counts of verdicts, taken batch by batch while the calls are written."""
    folder = scratch_folder(spark, "observed-policy")
    calls = fx.calls_from_events(event_stream(spark, sf, folder))
    judged = policy.observe(policy.agent_policy(calls, "log_only", {"block_below": 2.5, "flag_below": 6.5}), "policy")
    seen = trackers.ObservedBatches("policy")
    spark.streams.addListener(seen)
    try:
        _run(trackers.write_batches(judged.select("call_id", "blocked", "flagged"), f"{folder}/out", f"{folder}/checkpoint"))
        seen.ended.wait(60)
    finally:
        spark.streams.removeListener(seen)
    counts = [seen.totals.get(c, 0) for c in ("rows", "blocked", "flagged", "allowed")]
    return spark.createDataFrame([counts], "rows bigint, blocked bigint, flagged bigint, allowed bigint")


def stream_guarded_turns(spark, sf):
    """Turns paired as they come and guarded; inputs without an answer come out when their time is over."""
    folder = scratch_folder(spark, "guarded-turns")
    # A conversation begins every ten minutes and has a turn a minute; every seventh answer takes an hour.
    rows = fx.turn_evaluations(spark, sf).drop("text", "confidence")
    slow = (F.col("role") == "assistant") & (F.col("conv_id") % 7 == 3)
    minutes = F.col("conv_id") * 10 + F.col("turn") + F.when(slow, 60).otherwise(0)
    rows = rows.withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200) + minutes * 60).cast("timestamp_ntz"))
    turns = timed_stream(spark, rows, folder, rows.schema)
    paired = pairs.stream_turn_pairs(turns, "conv_id", carry=["score", *DIM_COLUMNS], within="5 MINUTES")
    guarded = policy.guard_turns(paired, {"safety": 3.0}, {"privacy": 4.0, "fairness": 3.0}, output_col="out_score")
    _run(trackers.write_batches(guarded, f"{folder}/out", f"{folder}/checkpoint"))
    out = spark.read.parquet(f"{folder}/out")
    return out.select("conv_id", "turn", "answered", "late", "stage", "blocked", F.array_join("failed_dimensions", ",").alias("failed"))


def stream_request_metrics(spark, sf):
    """Request metrics per five-minute window."""
    folder = scratch_folder(spark, "request-metrics")
    log = telemetry.request_log(fx.requests_from_events(event_stream(spark, sf, folder), fx.opening_texts(spark, sf)))
    running = trackers.stream_request_metrics(log.withColumn("ts", F.col("ts").cast("timestamp")))
    _run(trackers.write_batches(running, f"{folder}/out", f"{folder}/checkpoint", mode="update"))
    out = trackers.latest(spark, f"{folder}/out", ["window_start", "endpoint"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _committed(spark, sf, name, rows_of):
    """Rows made of each call, written live to a committed table and read back."""
    folder = scratch_folder(spark, name)
    rows = rows_of(fx.calls_from_events(event_stream(spark, sf, folder)))
    _run(committed.write_committed(rows, f"{folder}/out", f"{folder}/checkpoint"))
    return committed.read_committed(spark, f"{folder}/out", rows.schema)


def stream_review_queue(spark, sf):
    """Review items written batch by batch."""

    def items(calls):
        noted = calls.withColumn("note", F.concat(F.lit("call "), F.col("call_id").cast("string")))
        return sinks.review_items(noted, "call_id", "note", threshold=3.0)

    return _committed(spark, sf, "review-queue", items).select("item_id", "source_key", "dimension", "score")


def stream_incidents(spark, sf):
    """Incident records written batch by batch."""
    return batch.incident_columns(_committed(spark, sf, "incidents", batch.incident_rows))


def stream_score_fanout(spark, sf):
    """Score rows written batch by batch."""
    return _committed(spark, sf, "score-fanout", lambda calls: batch.score_rows(batch.scored_calls(calls)))


def stream_request_dedup(spark, sf):
    """Which stored answer serves each request, live and exact."""
    folder = scratch_folder(spark, "request-dedup")
    rows = fx.requests_from_events(event_stream(spark, sf, folder), fx.opening_texts(spark, sf))
    answered = live.stream_request_reuse(
        rows.withColumn("key", dedup.request_key("endpoint", "body")),
        ["key"],
        ttl_seconds=3600,
        cacheable=F.col("endpoint").isin(*CACHED_ENDPOINTS),
        ok=F.col("error_type").isNull(),
    )
    _run(trackers.write_batches(answered, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out").select("request_id", "answer_id", "from_cache")


def stream_request_first_seen(spark, sf):
    """How often Spark's own duplicate filter lets a request through that it is to pass once."""
    folder = scratch_folder(spark, "request-first-seen")
    rows = fx.requests_from_events(event_stream(spark, sf, folder), fx.opening_texts(spark, sf))
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("key", dedup.request_key("endpoint", "body"))
    running = trackers.stream_dedup(rows, ["key"], ttl_seconds=1000 * 86_400)
    _run(trackers.write_batches(running, f"{folder}/out", f"{folder}/checkpoint"))
    return (
        spark.read.parquet(f"{folder}/out")
        .groupBy(
            "endpoint",
            F.get_json_object("body", "$.content").alias("content"),
            F.contains("body", F.lit('"meta":{"b":1')).alias("b_first"),
        )
        .agg(F.count(F.lit(1)).alias("let_through"))
    )


def stream_regenerations(spark, sf):
    """Users' events as regeneration steps, split into sessions by silence."""
    folder = scratch_folder(spark, "regenerations")
    running = trackers.stream_regeneration_sessions(fx.regeneration_steps(event_stream(spark, sf, folder)))
    _run(trackers.write_batches(running, f"{folder}/out", f"{folder}/checkpoint"))
    out = spark.read.parquet(f"{folder}/out").drop("batch_id")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_step_at", "last_step_at")})


STREAMS = (
    stream_session_metrics,
    stream_agent_sessions,
    stream_agent_patterns,
    stream_agent_summaries,
    stream_observed_policy,
    stream_guarded_turns,
    stream_request_metrics,
    stream_review_queue,
    stream_incidents,
    stream_score_fanout,
    stream_request_dedup,
    stream_request_first_seen,
    stream_regenerations,
)


def queries():
    return {f.__name__: f for f in STREAMS}
