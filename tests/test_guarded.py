"""Guards that score as they go, plug-in scorers, closing sessions."""

import json

import pandas as pd
from pyspark.sql import functions as F

from guardlake.operators import agent_sessions as agent
from guardlake.operators import aggregates, guarded, policy, regeneration, scoring
from guardlake.schemas import VIOLATION
from tests.test_agent_sessions import AS_OF, frame, sessions


def length_scorer(df, text_col, mode):
    """Every score is a tenth of the text's length; deep mode is sure."""
    value = F.length(text_col) / F.lit(10.0)
    dims = {c: value for c in ("d_safety", "d_privacy")} | {
        c: F.lit(None).cast("double") for c in scoring.DIM_COLUMNS if c not in ("d_safety", "d_privacy")
    }
    return df.withColumns({**dims, "score": value, "confidence": F.lit(1.0 if mode == "deep" else 0.5)})


def pairs(spark, *rows):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, text string, out_text string")


def test_blocked_inputs_are_not_scored_further(spark):
    df = pairs(spark, ("x" * 10, "y" * 90), ("x" * 90, "y" * 10), ("x" * 90, "y" * 90), ("x" * 90, None), (" ", "y" * 90))
    out = guarded.guard_conversations(df, {"safety": 5.0}, {"privacy": 5.0}, scorer=length_scorer)
    got = {r.id: (r.stage, r.blocked, r.out_score, r.result) for r in out.collect()}
    assert got == {
        0: ("input", True, None, None),
        1: ("output", True, 1.0, None),
        2: (None, False, 9.0, "y" * 90),
        3: (None, False, None, None),
        4: (None, False, 9.0, "y" * 90),
    }


def test_sides_without_thresholds_are_not_scored(spark):
    out = guarded.guard_conversations(pairs(spark, ("x", "y")), None, None, scorer=length_scorer, policy="BLOCK").first()
    assert (out.blocked, out.score, out.out_score, out.result) == (False, None, None, "y")


def test_low_confidence_outputs_are_scored_again(spark):
    df = pairs(spark, ("x" * 90, "y" * 90))
    plain = guarded.guard_conversations(df, None, {"privacy": 5.0}, scorer=length_scorer).first()
    deep = guarded.guard_conversations(df, None, {"privacy": 5.0}, scorer=length_scorer, upgrade_below=0.6).first()
    assert (plain.out_confidence, deep.out_confidence) == (0.5, 1.0)


def test_answers_are_read_scored_and_gated(spark):
    def answer(text):
        return json.dumps({"content": [{"type": "text", "text": text}], "usage": {"input_tokens": 1, "output_tokens": 2}})

    df = spark.createDataFrame([(0, answer("y" * 90), False), (1, answer("y"), False), (2, answer("y"), True), (3, "{}", False)], "id int, json string, skip boolean")
    out = guarded.guard_answers(df, "json", "blocks", {"safety": 5.0}, scorer=length_scorer, skip_col="skip")
    got = {r.id: (r.skipped, r.blocked, r.score, r.total_tokens) for r in out.collect()}
    assert got == {0: (False, False, 9.0, 3), 1: (False, True, 0.1, 3), 2: (True, False, 0.0, 3), 3: (True, False, 0.0, 0)}


def test_contents_are_validated_then_scored_once(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["x" * 20, "x" * 20, "short", " "])], "id int, text string")
    scored, rejected = guarded.evaluate_contents(df, scorer=length_scorer)
    assert sorted((r.id, r.score) for r in scored.collect()) == [(0, 2.0), (1, 2.0)] and rejected.count() == 2
    assert guarded.evaluate_and_aggregate(df, scorer=length_scorer).first().total_evaluations == 2
    names = {r.name for r in guarded.trace_contents(df.limit(1), "id", scorer=length_scorer).collect()}
    assert names == {"rail_score", "rail_confidence", "rail_safety", "rail_privacy"}


def test_pandas_scorer_and_callback(spark):
    scorer = scoring.pandas_scorer(lambda texts, mode: pd.DataFrame({"score": texts.str.len(), "confidence": 1, "d_safety": texts.str.len()}))
    df = spark.createDataFrame([("a",), ("bbbbbbbbb",)], "text string")
    scored = scoring.score(df, scorer=scorer, weights={"safety": 50, "privacy": 50}).orderBy("text").collect()
    assert [(r.score, r.d_safety, r.d_privacy) for r in scored] == [(0.5, 1.0, None), (4.5, 9.0, None)]

    @F.pandas_udf("string")
    def shout(texts: pd.Series) -> pd.Series:
        assert (texts.str.len() < 5).all(), "rows that pass must not reach the callback"
        return texts.str.upper()

    enforced = policy.enforce_policy(scoring.score(df, scorer=scorer), "CUSTOM", {"safety": 5.0})
    out = {r.text: r.replacement for r in policy.replace_failed(enforced, shout("text")).collect()}
    assert out == {"a": "A", "bbbbbbbbb": None}


def test_best_rewrite_is_attached(spark):
    rows = [(1, 1, 3.0, "a"), (1, 2, 9.0, "b"), (2, 1, 3.0, "c")]
    candidates = spark.createDataFrame(rows, "k int, iteration int, score double, text string")
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    out = regeneration.attach_best(df, candidates, "k", 8.0, max_iterations=2)
    assert {r.k: r.regenerated for r in out.collect()} == {1: "b", 2: "c", 3: None}


def test_rollup_adds_subtotals(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "g string, score double")
    out = {r.g: r.average_score for r in aggregates.aggregate_scores(df, "g", rollup=True).collect()}
    assert out == {"a": 1.0, "b": 3.0, None: 2.0}


def test_closed_sessions_count_accepted_calls_only(spark):
    calls = frame(spark, {0: sessions(1, [9])[0]}).withColumn("violations", F.array().cast(f"array<{VIOLATION}>"))
    out = agent.close_sessions(calls, AS_OF, max_calls=4).first()
    fifth = calls.orderBy("ts", "call_id").collect()[4].ts
    assert (out.status, out.total_tool_calls, out.closed_at) == ("closed", 4, fifth)
