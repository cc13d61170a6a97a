"""Scorers that run once: in the loop of a conversation, behind guards, with a model per worker."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from guardlake.operators import conversations, guarded, scoring


def depth_scorer(df, text_col, mode):
    tenths = F.length(text_col) * (7 if mode == "basic" else 11) % 100
    return df.withColumns({"score": F.when(F.length(text_col) != 13, tenths / F.lit(10.0)), "confidence": F.lit(0.5)})


def fold(turns, deep_every, explicit):
    out, low = [], False
    for n, (_, text, asked) in enumerate(turns, 1):
        mode = (asked if explicit and asked else None) or ("deep" if (deep_every and n % deep_every == 0) or low else "basic")
        score = None if text is None or len(text) == 13 else len(text) * (7 if mode != "deep" else 11) % 100 / 10.0
        low = score is not None and score < 7.0
        out.append((n, mode, score))
    return out


@pytest.mark.parametrize("deep_every", [0, 1, 2, 5])
@pytest.mark.parametrize("explicit", [False, True])
def test_depth_in_the_loop_like_a_fold(spark, monkeypatch, deep_every, explicit):
    monkeypatch.setattr(conversations, "TURNS", 3)
    rnd = random.Random(deep_every)
    given = {key: [(i * 10, None if rnd.random() < 0.05 else "x" * rnd.randint(0, 40), rnd.choice([None, None, "", "deep", "basic"]))
                   for i in range(n)] for key, n in (("a", 1), ("b", 2), (None, 9), ("hot", 120), ("c", 30))}
    rows = [(k, *t) for k, turns in given.items() for t in turns]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv string, turn int, text string, asked string").withColumn("score", F.lit("old"))
    out = conversations.score_conversations(
        df, "conv", "turn", depth_scorer, deep_every=deep_every, explicit_col="asked" if explicit else None, chunk_rows=16
    )
    assert out.columns == ["conv", "turn", "text", "asked", "turn_number", "mode", "score", "confidence"]
    got = {}
    for r in out.orderBy("turn").collect():
        got.setdefault(r.conv, []).append((r.turn_number, r.mode, r.score))
    assert got == {k: fold(t, deep_every, explicit) for k, t in given.items()}
    assert conversations.score_conversations(df.where("false"), "conv", "turn", depth_scorer, deep_every=deep_every).count() == 0


def test_logged_depth_agrees_with_the_loop(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text")
    out = conversations.score_conversations(turns, "conv_id", "turn", depth_scorer)
    log = conversations.conversation_mode(out.withColumnRenamed("mode", "used").drop("turn_number"), "conv_id", ["turn"])
    assert log.where("mode <> used").isEmpty() and log.where("mode = 'deep'").count() > 0


def test_one_model_per_worker_on_awkward_rows(spark):
    built, runs = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def setup():
        built.add(1)
        return {"calls": 0}

    def fn(model, texts, mode):
        runs.add(1)
        model["calls"] += 1
        assert texts.notna().all() and (len(texts) == 1 or texts.str.len().sum() <= 100)
        return pd.DataFrame({"score": texts.str.len().to_numpy(), "confidence": 1.0, "d_safety": None})

    rows = [(0, None), (1, ""), (2, "é" * 80), (3, "x" * 5000), *((i, "y" * (i % 40)) for i in range(4, 300)), (7, None)]
    df = spark.createDataFrame(rows, "id int, text string").withColumns({"score": F.lit(-1.0), "_wanted_text": F.lit(1)}).repartition(3)
    scorer = scoring.model_scorer(setup, fn, batch_bytes=100)
    out = scoring.score_where(df.drop("_wanted_text"), F.col("id") % 2 == 0, scorer=scorer)
    got = sorted((r.id, r.score, r.confidence) for r in out.collect())
    want = [(i, (None if t is None else float(len(t))) if i % 2 == 0 else -1.0, 1.0 if i % 2 == 0 and t is not None else None) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert built.value <= 8 and runs.value > built.value
    assert out.columns[:3] == ["id", "text", "score"] and "d_safety" in out.columns
    before = built.value
    scoring.score_where(out, F.col("id") % 2 == 1, scorer=scorer, prefix="again_").collect()
    assert built.value <= max(before, 8)


def test_guard_reads_its_pairs_once(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = conversations.pair_turns(turns, "conv_id", ["turn"], carry=("text",))
    out = guarded.guard_conversations(pairs, {"privacy": 8.0}, {"privacy": 9.0}, upgrade_below=0.6)
    plain, guarded_plan = (f._jdf.queryExecution().optimizedPlan().toString() for f in (pairs, out))
    assert guarded_plan.count("parquet") == plain.count("parquet") and "Union" not in guarded_plan
