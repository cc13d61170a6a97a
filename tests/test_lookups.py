"""Salted lookups give the plain left join."""

import pytest
from pyspark.sql import functions as F

from guardlake.operators.conversations import since_reset
from guardlake.operators.lookups import hot_keys, lookup_join
from guardlake.operators.scoring import score_distinct


@pytest.mark.parametrize("chunk_rows", [1 << 20, 40])
def test_same_as_a_left_join(spark, chunk_rows):
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("string"))
    left = spark.range(3000).select("id", key.alias("k"))
    right = spark.createDataFrame([("hot", 1), ("3", 3), ("none", 4)], "k string, v int")
    got = lookup_join(left, right, ["k"], ["id"], chunk_rows=chunk_rows)
    want = left.join(right, "k", "left")
    assert got.count() == 3000
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).isEmpty()


def test_only_hot_keys_get_salts(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(left, ["k"], ["id"], 100).collect()
    assert [r.k for r in hot] == [0] and 8 <= hot[0]["_salts"] <= 40


def test_copies_and_resets_with_salts(spark):
    docs = spark.range(500).select("id", F.when(F.col("id") % 2 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    plain = score_distinct(docs).select("id", "score")
    assert score_distinct(docs, chunk_rows=10).select("id", "score").exceptAll(plain).isEmpty()
    log = spark.range(300).select(F.lit(1).alias("s"), F.col("id").alias("ts"))
    resets = spark.createDataFrame([(1, 10), (1, 200), (2, 5)], "s int, reset_at long")
    assert since_reset(log, resets, "s", chunk_rows=10).count() == 99
