"""Live sessions and live answers equal the batch operators, however the rows come in."""

import random

import pytest
from pyspark.sql import functions as F

from guardlake.operators import agent_sessions as agent
from guardlake.operators import dedup
from guardlake.plans import fixtures as fx
from guardlake.streaming import live, trackers

AS_OF = "2024-12-31 00:00:00"
AS_OF_US = 1_735_603_200_000_000
LIMITS = dict(max_calls=40, ttl_minutes=20 * 24 * 60)


def laid_out(df, path, cuts):
    """Write the rows in stretches of time, one file each; returns the schema."""
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df.where((F.lit(low is None) | (F.col("ts") >= F.lit(low))) & (F.lit(high is None) | (F.col("ts") < F.lit(high))))
        part.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def source(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(frame, tmp_path):
    query = trackers.write_batches(frame, str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination(240)
    assert query.exception() is None
    return str(tmp_path / "out")


def same(got, want):
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


LAYOUTS = [[], ["2024-01-09", "2024-01-16", "2024-01-23"], [f"2024-01-{d:02d}" for d in range(2, 30, 4)]]


@pytest.mark.parametrize("cuts, block", [(LAYOUTS[0], True), (LAYOUTS[1], False), (LAYOUTS[1], True), (LAYOUTS[2], True)])
def test_sessions_equal_batch(spark, sf_dir, tmp_path, cuts, block):
    calls = fx.agent_calls(spark, sf_dir)
    # One session holds a third of all rows; texts as ids.
    calls = calls.withColumn("session_id", F.when(F.col("call_id") % 3 == 0, -1).otherwise(F.col("session_id")))
    calls = calls.withColumn("call_id", F.format_string("c%07d", "call_id"))
    schema = laid_out(calls, str(tmp_path / "in"), cuts)
    rules = dict(deep_every_n=7, escalate_after_flags=2, base_mode="basic")
    frame = live.stream_agent_sessions(
        source(spark, str(tmp_path / "in"), schema), block_after_critical=block, as_of=AS_OF_US, forget_minutes=60 * 24 * 60, **LIMITS, **rules
    )
    out = run(frame, tmp_path)
    accepted = agent.accept_calls(calls, block_after_critical=block, **LIMITS)
    modes = agent.agent_mode(calls, **rules)
    want = accepted.select("call_id", "accepted", "reject_reason").join(modes.select("call_id", "mode"), "call_id")
    want = want.withColumn("mode", F.when(F.col("accepted"), F.col("mode")))
    same(live.session_calls(spark, out).select(want.columns), want)
    kept = accepted.where("accepted")
    found = agent.risk_summary(kept, AS_OF, status=agent.session_status(accepted))
    figures = ["session_id", "status", "closed_at", "total_tool_calls", "allowed", "flagged", "blocked", "critical_violations",
               "distinct_violations", F.round("current_risk_score", 8).alias("risk"), "risk_trend", "total_credits"]
    latest = live.session_summaries(spark, out)
    same(latest.select(figures), found.select(figures))
    same(
        latest.select("session_id", F.posexplode("patterns").alias("at", "p")).select("session_id", "at", "p.*"),
        agent.detect_patterns(kept, AS_OF).withColumnRenamed("ordinal", "at"),
    )


def plain_calls(spark, rows):
    """Calls (session, second, call_id, tool, decision, score) with the other columns empty."""
    df = spark.createDataFrame(rows, "session_id string, second int, call_id int, tool_name string, decision string, score double")
    none = {c: F.lit(None).cast("double") for c in live.DIM_COLUMNS}
    return df.withColumns(
        none
        | {
            "ts": F.timestamp_seconds(F.lit(1704067200) + F.col("second")).cast("timestamp_ntz"),
            "pii_fields": F.array().cast("array<string>"),
            "violations": F.array().cast("array<struct<framework:string,article:string,severity:string>>"),
            "credits": F.lit(None).cast("double"),
        }
    ).drop("second")


def test_silent_sessions_expire(spark, tmp_path):
    batches = [
        [("a", 0, 1, "t", "BLOCK", 5.0), ("b", 0, 2, None, "BLOCK", None), (None, 1, 3, "t", "ALLOW", 1.0)],
        [("a", 60, 4, "t", "FLAG", 4.0), ("b", 120, 5, None, "ALLOW", 3.0)],
        [("c", 9000, 6, "t", "ALLOW", 9.0)],
        [("a", 9100, 7, "t", "ALLOW", 8.0), ("c", 9200, 8, "t", "ALLOW", 8.0)],
    ]
    schema = None
    for rows in batches:
        calls = plain_calls(spark, rows)
        calls.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        schema = calls.schema
    frame = live.stream_agent_sessions(source(spark, str(tmp_path / "in"), schema), ttl_minutes=60, watermark="1 minute")
    out = run(frame, tmp_path)
    ended = spark.read.parquet(out).where("expired").select("session_id", "total_attempts")
    assert {tuple(r) for r in ended.collect()} == {("a", 2), ("b", 2), (None, 1)}
    latest = {r.session_id: r for r in live.session_summaries(spark, out).collect()}
    assert latest["a"].total_attempts == 1 and not latest["a"].expired  # began anew
    assert latest["c"].total_attempts == 2 and latest[None].expired
    assert [p.description for p in latest["b"].patterns] == [None]
    calls = {r.call_id: r for r in live.session_calls(spark, out).collect()}
    assert calls[7].attempt == 1 and all(r.accepted for r in calls.values())


def test_restarted_query_goes_on_from_its_state(spark, tmp_path):
    calls = plain_calls(spark, [("a", i, i, "t", "FLAG", 5.0) for i in range(4)])
    calls.coalesce(1).write.parquet(str(tmp_path / "in"))
    for more in range(2):
        if more:
            plain_calls(spark, [("a", 10, 10, "t", "ALLOW", 2.0)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        frame = live.stream_agent_sessions(source(spark, str(tmp_path / "in"), calls.schema), max_calls=4)
        out = run(frame, tmp_path)
    rows = {r.call_id: r for r in live.session_calls(spark, out).collect()}
    assert (rows[10].attempt, rows[10].flag_run, rows[10].reject_reason) == (5, 4, "max_tool_calls")
    assert live.session_summaries(spark, out).first().status == "closed"


@pytest.mark.parametrize("layout", range(4))
def test_answers_equal_batch(spark, tmp_path, layout):
    rnd = random.Random(layout)
    rows, t = [], {}
    for i in range(900):
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        t[key] = t.get(key, 0) + rnd.choice([0, 1, 40, 100, 299, 300, 301])
        rows.append((f"r{i:04d}", key, t[key], rnd.random() < 0.9, rnd.random() < 0.8))
    df = spark.createDataFrame(rows, "request_id string, key string, second int, asked boolean, ok boolean")
    df = df.withColumn("ts", F.timestamp_seconds("second"))
    span = max(t.values())
    cuts = sorted(rnd.sample(range(span), [0, 1, 3, 6][layout]))
    schema = laid_out(df, str(tmp_path / "in"), [F.timestamp_seconds(F.lit(c)) for c in cuts])
    conditions = dict(cacheable=F.col("asked"), ok="ok")
    frame = live.stream_request_reuse(source(spark, str(tmp_path / "in"), schema), ["key"], **conditions)
    got = spark.read.parquet(run(frame, tmp_path)).select("request_id", "answer_id", "from_cache")
    same(got, dedup.dedup_requests(df, ["key"], **conditions).select(got.columns))


def test_a_pause_inside_one_batch_begins_anew(spark, tmp_path):
    calls = plain_calls(spark, [("a", i if i < 5 else 10_000 + i, i, "t", "ALLOW", 5.0) for i in range(9)])
    calls.coalesce(1).write.parquet(str(tmp_path / "in"))
    frame = live.stream_agent_sessions(source(spark, str(tmp_path / "in"), calls.schema), max_calls=3, ttl_minutes=60)
    out = run(frame, tmp_path)
    rows = {r.call_id: (r.attempt, r.accepted) for r in live.session_calls(spark, out).collect()}
    assert rows == {i: (n, n <= 3) for i, n in enumerate([1, 2, 3, 4, 5, 1, 2, 3, 4])}
    assert live.session_summaries(spark, out).first().total_tool_calls == 3


def test_packs_hold_the_first_details_only(spark):
    rows = spark.range(100).selectExpr("id % 3 as key", "100 - id as us", "id", "struct(id as x) as detail").coalesce(1)
    packs = live.packed(rows, "key", most=5).collect()
    assert sorted(p.key for p in packs) == [0, 1, 2]
    for p in packs:
        assert p.us == sorted(p.us) and len(p.us) in (33, 34)
        assert [d and d.x for d in p.detail] == p.id[:5] + [None] * (len(p.id) - 5) and p.seen.timestamp() * 1e6 == pytest.approx(p.us[-1])
