"""Time-to-live chain against a plain fold."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from guardlake.operators import dedup, reuse_chain
from guardlake.operators.dedup import dedup_requests, request_key
from tests.folds import sent


@pytest.mark.parametrize("span, records", [(16, 10_000), (1, 10_000), (2, 7), (40, 3)])
def test_chain(spark, monkeypatch, span, records):
    monkeypatch.setattr(dedup, "SPAN", span)
    rnd = random.Random(span)
    rows, t = [], {}
    for i in range(700):
        key = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        t[key] = t.get(key, 0) + rnd.choice([0, 1, 40, 100, 299, 300, 301]) * 1_000_000
        rows.append((i, key, t[key]))
    df = spark.createDataFrame(rows, "request_id bigint, key string, us bigint").withColumn(
        "ts", F.timestamp_micros("us")
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = dedup_requests(df.repartition(4), ["key"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows)
    for key in {k for _, k, _ in rows}:
        mine = sorted((us, i) for i, k, us in rows if k == key)
        misses = sent([us for us, _ in mine], 300_000_000)
        ids = {m: min(i for us, i in mine if us == m) for m in misses}
        for r in got:
            if r.key != key:
                continue
            serving = max(m for m in misses if m <= r.us)
            assert r.answer_id == ids[serving]
            assert r.from_cache == (r.request_id != ids[serving])


def test_boundary(spark):
    seconds = [0, 100, 299, 300, 301, 700]
    df = spark.createDataFrame([(s, "k") for s in seconds], "request_id bigint, key string").withColumn(
        "ts", F.timestamp_seconds("request_id")
    )
    out = dedup_requests(df, ["key"]).where(~F.col("from_cache")).orderBy("request_id").collect()
    assert [r.request_id for r in out] == [0, 301, 700]


def test_request_key_ignores_field_order(spark):
    rows = [('{"b":1,"a":"x"}',), ('{"a":"x","b":1}',), ('{"a":"x","b":"1"}',), ("not json",)]
    keys = [r[0] for r in spark.createDataFrame(rows, "body string").select(request_key(F.lit("eval"), "body")).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 3


def test_request_key_sorts_the_top_level_only(spark):
    rows = [
        ('{"b":{"x":1,"y":2},"a":1}',), ('{"a":1,"b":{"x":1,"y":2}}',), ('{"a":1,"b":{"y":2,"x":1}}',), ('{"a":"1","b":{"x":1,"y":2}}',),
        ('{"a":null}',), ('{"a":"null"}',), ('{"a":"{}"}',), ('{"a":{}}',), ("[1]",), (None,), ("",), ('{"a,b":"c"}',), ('{"a":"b","c":""}',),
    ]
    keys = [r[0] for r in spark.createDataFrame(rows, "body string").select(request_key(F.lit("eval"), "body")).collect()]
    assert keys[0] == keys[1] and keys[9] == keys[10]
    assert len(set(keys)) == len(keys) - 2


def test_only_successful_answers_of_cached_endpoints_are_reused(spark):
    rows = [
        (1, 0, "eval", "RateLimitError"), (2, 10, "eval", None), (3, 20, "eval", None), (4, 30, "eval", "TimeoutError"),
        (5, 311, "eval", "TimeoutError"), (6, 312, "eval", None), (7, 0, "agent", None), (8, 1, "agent", None), (9, 2, "agent", "TimeoutError"),
    ]
    df = spark.createDataFrame(rows, "request_id int, second int, endpoint string, error string").withColumn("ts", F.timestamp_seconds("second"))
    out = dedup_requests(df, ["endpoint"], cacheable=F.col("endpoint") == "eval", ok=F.col("error").isNull())
    assert {r.request_id: (r.answer_id, r.from_cache) for r in out.collect()} == {
        1: (None, False), 2: (2, False), 3: (2, True), 4: (2, True), 5: (None, False), 6: (6, False),
        7: (7, False), 8: (8, False), 9: (None, False),
    }
    assert out.columns == [*df.columns, "answer_id", "from_cache"]


def test_long_run_in_blocks(spark):
    n = 20_000
    df = spark.range(n).selectExpr("id as request_id", "'k' as key", "timestamp_seconds(id * 200) as ts")
    out = dedup_requests(df, ["key"]).where("from_cache").agg(F.count("*"), F.min("answer_id"), F.max("answer_id")).first()
    assert tuple(out) == (n // 2, 0, n - 2)


def test_step_functions_and_answers_of_many_groups():
    rnd = random.Random(5)
    for _ in range(300):
        ttl, groups = rnd.choice([0, 1, 7, 50]), []
        for _ in range(rnd.randint(1, 4)):
            t = rnd.choice([-1000, 0, 10**15])
            groups.append(sorted(t + rnd.choice([rnd.randint(0, 20), rnd.randint(0, 400)]) for _ in range(rnd.randint(1, 30))))
        sizes = [len(g) for g in groups]
        starts, us = np.cumsum([0, *sizes[:-1]]), np.array(sum(groups, []), np.int64)
        group, threshold, last = reuse_chain.exits(starts, us, ttl)
        for i, g in enumerate(groups):
            own = np.flatnonzero(group == i)
            assert (threshold[own][1:] >= threshold[own][:-1]).all()
            for expiry in [None, *range(g[0] - 3, g[0] + ttl + 1)]:
                left = [t for t in g if expiry is None or t > expiry]
                want = sent(left, ttl)[-1:]
                step = own[np.searchsorted(threshold[own], np.iinfo(np.int64).min if expiry is None else expiry, "right") - 1]
                assert ([] if last[step] < 0 else [us[last[step]]]) == want
                if want:
                    assert last[step] == starts[i] + g.index(want[0])
        stores = np.array([rnd.random() < 0.8 for _ in us])
        serving, is_sent = reuse_chain.answers(starts, us, stores, np.zeros(len(us), bool), ttl)
        for a, n in zip(starts, sizes):
            rows = range(a, a + n)
            times = sent([us[i] for i in rows if stores[i]], ttl)
            firsts = [next(i for i in rows if stores[i] and us[i] == t) for t in times]
            assert [i for i in rows if is_sent[i]] == firsts
            for i in rows:
                before = [f for f in firsts if f <= i and us[i] <= us[f] + ttl]
                assert serving[i] == (before[-1] if before else -1)


def test_groups_come_whole_whatever_the_batches():
    rnd = random.Random(6)
    for _ in range(100):
        keys = sorted(rnd.choices("abcd", k=rnd.randint(0, 20)))
        batches, first = [], 0
        while first < len(keys):
            n = rnd.randint(0, 5)
            batches.append(pa.RecordBatch.from_pydict({"k": pa.array(keys[first : first + n], pa.string())}))
            first += n
        tables = list(reuse_chain.complete_groups(batches, ["k"]))
        seen = [t.column("k").to_pylist() for t in tables]
        assert sum(seen, []) == keys
        assert sum(len(set(s)) for s in seen) == len(set(keys))


def test_rows_that_take_no_part(spark):
    rows = [(1, "k", 0), (1, "k", 0), (2, "k", None), (None, "k", 5), (3, None, 0), (4, None, 1), (5, "", 0)]
    df = spark.createDataFrame(rows, "request_id int, key string, second int").withColumn("ts", F.timestamp_seconds("second"))
    out = dedup_requests(df.withColumn("answer", F.lit(1)), ["key"])
    got = sorted(((r.request_id, r.answer_id, r.from_cache) for r in out.collect()), key=str)
    assert got == sorted([(1, 1, False), (1, 1, False), (2, 2, False), (None, 1, True), (3, 3, False), (4, 3, True), (5, 5, False)], key=str)
    assert dedup_requests(df.where("false"), ["key"]).count() == 0


def test_plan_is_one_for_every_key(spark):
    df = spark.range(10).selectExpr("id as request_id", "'k' as key", "timestamp_seconds(id * 200) as ts")
    plan = dedup_requests(df, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") + plan.count("Exchange(") <= 6
    assert plan.count("Range (") <= 4
