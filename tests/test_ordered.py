"""Ordered columns against a plain fold, with and without split keys."""

import random

import pytest
from pyspark.sql import functions as F

from guardlake.operators.ordered import ordered_columns


def fold(rows):
    out = {}
    by_key = {}
    for key, ts, rid, v in rows:
        by_key.setdefault(key, []).append((ts, rid, v))
    for key, group in by_key.items():
        group.sort()
        for i, (ts, rid, v) in enumerate(group):
            low = [j for j in range(i) if group[j][2] < 3]
            low_incl = [j for j in range(i + 1) if group[j][2] < 3]
            nxt = [j for j in range(i + 1, len(group)) if group[j][2] < 3]
            out[rid] = (
                i + 1,
                len(group),
                group[i - 1][2] if i else None,
                group[i + 1][2] if i + 1 < len(group) else None,
                group[0][0],
                low[-1] + 1 if low else None,
                low[0] + 1 if low else None,
                group[low_incl[-1]][1] if low_incl else None,
                group[nxt[0]][1] if nxt else None,
            )
    return out


@pytest.mark.parametrize("chunk_rows", [1 << 20, 40, 7, 1])
def test_matches_fold(spark, chunk_rows):
    rnd = random.Random(chunk_rows)
    rows = []
    for rid in range(900):
        key = 1 if rnd.random() < 0.4 else rnd.choice([2, 3, 4, 5, None])
        rows.append((key, rnd.randrange(120), rid, rnd.randrange(10)))
    df = spark.createDataFrame(rows, "k int, ts long, rid long, v int").repartition(5)
    low = F.col("v") < 3
    got = ordered_columns(
        df,
        ["k"],
        ["ts", "rid"],
        chunk_rows=chunk_rows,
        number="n",
        total="total",
        lag={"prev": "v"},
        lead={"nxt": "v"},
        first={"start": "ts"},
        last_position={"lp": low},
        first_position={"fp": low},
        last_value={"lv": (low, "rid")},
        next_value={"nv": (low, "rid")},
    ).collect()
    want = fold(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.total, r.prev, r.nxt, r.start, r.lp, r.fp, r.lv, r.nv) == want[r.rid]


def test_hot_key_is_spread(spark):
    df = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("rid"))
    out = ordered_columns(df, ["k"], ["rid"], chunk_rows=500, number="n", keep_chunk=True)
    chunks = out.groupBy("_chunk").count().collect()
    assert len(chunks) > 20
    assert max(c["count"] for c in chunks) < 20000 / 4
    assert out.where("n <> rid + 1").isEmpty()
