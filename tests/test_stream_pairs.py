"""Live pairs equal batch pairs over any layout; metrics come batch by batch."""

import pytest
from pyspark.sql import functions as F

from guardlake.operators import conversations, policy
from guardlake.plans import fixtures as fx
from guardlake.schemas import EVENTS
from guardlake.streaming import pairs, trackers


def written(rows, path, parts):
    """Rows in order of time, in so many files."""
    ordered = sorted(rows.collect(), key=lambda r: (r.ts, r.conv, r.turn))
    size = -(-len(ordered) // parts)
    for a in range(0, len(ordered), size):
        rows.sparkSession.createDataFrame(ordered[a : a + size], rows.schema).coalesce(1).write.mode("append").parquet(path)


def run(frame, tmp_path):
    query = trackers.write_batches(frame, str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination(240)
    assert query.exception() is None
    return frame.sparkSession.read.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_pairs_equal_batch(spark, tmp_path, parts):
    roles = {"a": "uaua", "b": "uuau", "c": "aua", "d": "usua", "hot": "ua" * 40}
    rows = [(c, n, {"u": "user", "a": "assistant", "s": "system"}[x], f"{c}{n}", n * 60) for c, s in roles.items() for n, x in enumerate(s)]
    rows += [("slow", 0, "user", "q", 0), ("slow", 1, "assistant", "late answer", 4000), ("end", 0, "user", "q", 90_000), ("end", 1, "assistant", "a", 90_001)]
    df = spark.createDataFrame(rows, "conv string, turn int, role string, text string, second int")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("second"))).drop("second")
    written(df, str(tmp_path / "in"), parts)
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live = pairs.stream_turn_pairs(source, "conv", carry=["text"], within="30 MINUTES", watermark="1 minute")
    got = {(r.conv, r.turn, r.text, r.out_text, r.answered, r.late) for r in run(live, tmp_path).collect()}
    batch = conversations.pair_turns(df, "conv", ["turn"], carry=("text",))
    want = {(r.conv, r.turn, r.text, r.out_text, r.answered, False) for r in batch.collect()}
    want -= {("slow", 0, "q", "late answer", True, False)}
    want |= {("slow", 0, "q", None, False, False), ("slow", 0, None, "late answer", False, True), ("c", -1, None, "c0", False, True)}
    assert got == want


def test_metrics_of_every_batch(spark, sf_dir, tmp_path):
    events = fx.read(spark, sf_dir, "events")
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-01-20"), ("2024-01-20", "2025-01-01")):
        events.where((F.col("ts") >= low) & (F.col("ts") < high)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    judged = policy.observe(policy.agent_policy(fx.calls_from_events(source), "log_only", {"block_below": 2.5, "flag_below": 6.5}), "verdicts")
    seen = {}
    listener = trackers.ObservedBatches("verdicts", lambda batch_id, counts: seen.update({batch_id: counts}))
    spark.streams.addListener(listener)
    try:
        out = run(judged.select("call_id", "blocked", "flagged", "allowed"), tmp_path)
        assert listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
    want = out.groupBy("batch_id").agg(F.count("*").alias("rows"), *[F.count_if(c).alias(c) for c in ("blocked", "flagged", "allowed")])
    want = {r.batch_id: {c: r[c] for c in ("rows", "blocked", "flagged", "allowed")} for r in want.collect()}
    assert {b: c for b, c in seen.items() if c["rows"]} == want and len(want) == 3
    assert listener.totals["rows"] == events.count()
