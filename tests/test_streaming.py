"""Streams over several micro-batches give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from guardlake.operators import regeneration
from guardlake.plans import fixtures as fx
from guardlake.schemas import EVENTS
from guardlake.sources import sinks
from guardlake.streaming import trackers


@pytest.fixture(scope="module")
def parts(spark, sf_dir, tmp_path_factory):
    """The events in four files by time, so a stream reads them as four batches."""
    path = str(tmp_path_factory.mktemp("events"))
    events = fx.read(spark, sf_dir, "events")
    cuts = ["2024-01-01", "2024-01-09", "2024-01-16", "2024-01-23", "2025-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        part = events.where((F.col("ts") >= low) & (F.col("ts") < high))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None


def test_conversation_metrics(spark, sf_dir, parts, tmp_path):
    turns = fx.calls_from_events(stream(spark, parts)).withColumn("at", F.struct("ts", "call_id"))
    live = trackers.stream_conversation_metrics(turns, "session_id", "at")
    finish(trackers.write_batches(live, str(tmp_path / "out"), str(tmp_path / "c"), mode="update"))
    got = {r.session_id: r for r in trackers.latest(spark, str(tmp_path / "out"), ["session_id"]).collect()}
    by = {}
    for r in fx.agent_calls(spark, sf_dir).orderBy("ts", "call_id").collect():
        by.setdefault(r.session_id, []).append(r.score)
    assert set(got) == set(by)
    for session, scores in by.items():
        r = got[session]
        assert (r.turn_count, r.last_score, r.min_score) == (len(scores), scores[-1], min(scores))
        assert r.average_score == pytest.approx(sum(scores) / len(scores))
        assert r.next_mode == ("deep" if (len(scores) + 1) % 5 == 0 or scores[-1] < 7.0 else "basic")


def test_items_once_per_source_row(spark, parts, sf_dir, tmp_path):
    seen = []
    calls = fx.calls_from_events(stream(spark, parts)).withColumn("note", F.lit("n"))

    def items(batch):
        return sinks.review_items(batch, "call_id", "note", threshold=3.0)

    finish(
        trackers.write_batches(
            calls, str(tmp_path / "out"), str(tmp_path / "c"), transform=items,
            observer=lambda df, batch_id: seen.append((batch_id, df.count())),
        )
    )
    want = items(fx.agent_calls(spark, sf_dir).withColumn("note", F.lit("n")))
    got = trackers.distinct_items(spark, str(tmp_path / "out"))
    assert got.count() == want.count() == sum(n for _, n in seen)
    assert got.select("item_id").exceptAll(want.select("item_id")).isEmpty()


def write_steps(spark, path, rows):
    df = spark.createDataFrame(rows, "session_id bigint, second int, iteration int, met boolean")
    df.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("second"))).drop("second").coalesce(1).write.mode(
        "append"
    ).parquet(path)


def test_regeneration_sessions_expire(spark, tmp_path):
    path = str(tmp_path / "in")
    write_steps(spark, path, [(1, 0, 1, False), (2, 0, 1, False), (3, 0, 1, True)])
    write_steps(spark, path, [(2, 600, 2, True), (9, 4000, 1, False)])
    write_steps(spark, path, [(9, 4001, 2, False)])
    schema = "session_id bigint, iteration int, met boolean, ts timestamp"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    live = trackers.stream_regeneration_sessions(source)
    finish(trackers.write_batches(live, str(tmp_path / "out"), str(tmp_path / "c")))
    got = {(r.session_id, r.outcome, r.steps) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, "expired", 1), (2, "passed", 2), (3, "passed", 1)}


@pytest.mark.parametrize("layout", [[10], [1] * 10, [3, 3, 4], [5, 5]])
def test_regeneration_sessions_do_not_depend_on_batches(spark, tmp_path, layout):
    # Steps an hour apart, two on the limit, then a last one that moves the watermark on.
    seconds = [0, 3600, 7200, 8100, 9001, 10_800, 14_400, 14_500, 15_300, 90_000]
    rows = [(1 if i < 9 else 9, s, i, s == 8100) for i, s in enumerate(seconds)]
    path, first = str(tmp_path / "in"), 0
    for n in layout:
        write_steps(spark, path, rows[first : first + n])
        first += n
    schema = "session_id bigint, iteration int, met boolean, ts timestamp"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    live = trackers.stream_regeneration_sessions(source)
    finish(trackers.write_batches(live, str(tmp_path / "out"), str(tmp_path / "c")))
    batch = regeneration.regeneration_sessions(spark.read.schema(schema).parquet(path)).where("session_id = 1")
    fields = ["session_id", "outcome", "steps", "first_step_at", "last_step_at"]
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(fields).collect()))
    assert got == sorted(map(tuple, batch.select(fields).collect()))
    assert [r[2] for r in sorted(got, key=lambda r: r[3])] == [1, 1, 2, 1, 1, 3]


def test_dedup_lets_a_key_through_again_after_its_time(spark, tmp_path):
    path = str(tmp_path / "in")

    def write(rows):
        df = spark.createDataFrame(rows, "key string, second int")
        df.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("second"))).coalesce(1).write.mode("append").parquet(path)

    write([("a", 0), ("a", 10), ("b", 5)])
    write([("a", 20), ("c", 2000)])
    write([("c", 2002)])
    write([("a", 2001), ("c", 2003)])
    source = spark.readStream.schema("key string, second int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    live = trackers.stream_dedup(source, ["key"])
    finish(trackers.write_batches(live, str(tmp_path / "out"), str(tmp_path / "c")))
    sent = sorted(r.key for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert sent == ["a", "a", "b", "c"]
