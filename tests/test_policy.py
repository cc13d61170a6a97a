"""Policies, guards, plans, registry."""

import pytest
from pyspark.sql import functions as F

from guardlake.operators import plan_verdicts, policy, registry
from guardlake.operators.conversations import pair_turns
from guardlake.schemas import DIM_COLUMNS

DIMS = ", ".join(f"{c} double" for c in DIM_COLUMNS)


def evaluation(spark, *rows, extra="", schema=""):
    out = []
    for row in rows:
        out.append((row.get("score"), row.get("confidence", 0.9), *[row.get(c[2:]) for c in DIM_COLUMNS], *row.get("extra", ())))
    return spark.createDataFrame(out, f"score double, confidence double, {DIMS}{schema}")


LOW = {"score": 4.0, "safety": 3.0, "privacy": 8.0, "fairness": 4.0}
HIGH = {"score": 9.0, "safety": 9.0, "privacy": 8.0, "fairness": 9.0}


def test_log_only_and_block(spark):
    df = evaluation(spark, LOW, HIGH)
    out = policy.enforce_policy(df, "LOG_ONLY", {"safety": 7.0, "fairness": 7.0, "privacy": 7.0}).collect()
    assert [(r.passed, r.failed_dimensions, r.blocked) for r in out] == [(False, ["safety", "fairness"], False), (True, [], False)]
    out = policy.enforce_policy(df, "BLOCK", {"safety": 7.0}).collect()
    assert out[0].blocked and out[0].message == "Content blocked: dimensions [safety] below threshold"
    assert not out[1].blocked and out[1].message is None
    keep, stopped = policy.split_blocked(policy.enforce_policy(df, "BLOCK", {"safety": 7.0}))
    assert (keep.count(), stopped.count()) == (1, 1)


def test_missing_dimension_passes(spark):
    out = policy.enforce_policy(evaluation(spark, LOW), "BLOCK", {"user_impact": 9.0, "privacy": 8.0}).first()
    assert out.passed and not out.blocked


def test_regenerate_and_custom(spark):
    df = evaluation(spark, LOW, HIGH)
    out = policy.enforce_policy(df, "REGENERATE", {"safety": 7.0, "fairness": 8.0}, regenerated=F.lit("better")).collect()
    assert (out[0].replacement, out[0].target_score, out[0].blocked) == ("better", 8.0, False)
    assert (out[1].replacement, out[1].target_score) == (None, None)
    for given, want in (("own", "own"), ("", None), (None, None)):
        out = policy.enforce_policy(df, "CUSTOM", {"safety": 7.0}, custom=F.lit(given).cast("string")).first()
        assert out.replacement == want and not out.passed
    with pytest.raises(ValueError):
        policy.enforce_policy(df, "OTHER", {"safety": 7.0})


def pair(spark, in_safety, out_privacy):
    row = [(1, 0, "user", "question", in_safety, 9.0), (1, 1, "assistant", "answer", 9.0, out_privacy)]
    turns = spark.createDataFrame(row, "c int, turn int, role string, text string, d_safety double, d_privacy double")
    return pair_turns(turns, "c", ["turn"], carry=("text", "d_safety", "d_privacy"))


def test_guard_turns(spark):
    gates = ({"safety": 5.0}, {"privacy": 5.0})
    r = policy.guard_turns(pair(spark, 1.0, 1.0), *gates).first()
    assert (r.stage, r.blocked, r.result) == ("input", True, None)
    assert r.message == "input blocked: dimensions [safety] below threshold"
    r = policy.guard_turns(pair(spark, 9.0, 1.0), *gates).first()
    assert (r.stage, r.message) == ("output", "output blocked: dimensions [privacy] below threshold")
    r = policy.guard_turns(pair(spark, 9.0, 1.0), *gates, policy="BLOCK").first()
    assert r.message == "Output blocked: dimensions [privacy] below threshold"
    r = policy.guard_turns(pair(spark, 9.0, 1.0), *gates, policy="LOG_ONLY").first()
    assert (r.blocked, r.result) == (False, "answer")
    r = policy.guard_turns(pair(spark, 9.0, 1.0), None, None, policy="BLOCK").first()
    assert (r.blocked, r.result) == (False, "answer")
    for given, want in ((None, "answer"), ("", ""), ("x", "x")):
        r = policy.guard_turns(pair(spark, 9.0, 1.0), *gates, policy="CUSTOM", custom=F.lit(given).cast("string")).first()
        assert r.result == want
    for given, want in ((None, "answer"), ("", "answer"), ("x", "x")):
        r = policy.guard_turns(
            pair(spark, 9.0, 1.0), *gates, policy="REGENERATE", regenerated=F.lit(given).cast("string")
        ).first()
        assert r.result == want


def test_pairing_needs_an_answer_next(spark):
    rows = [(1, 0, "user"), (1, 1, "system"), (1, 2, "assistant"), (2, 0, "user"), (2, 1, "assistant"), (3, 0, "user")]
    turns = spark.createDataFrame([(*r, f"t{i}") for i, r in enumerate(rows)], "c int, turn int, role string, text string")
    out = {r.c: (r.answered, r.out_text) for r in pair_turns(turns, "c", ["turn"], carry=("text",)).collect()}
    assert out == {1: (False, None), 2: (True, "t4"), 3: (False, None)}


def test_guardrail(spark):
    df = evaluation(spark, LOW, HIGH)
    out = policy.guardrail(df, {"safety": 7.0, "fairness": 7.0}).collect()
    assert [(r.allowed, r.failed_dimensions) for r in out] == [(False, ["safety", "fairness"]), (True, None)]
    assert all(r.allowed for r in policy.guardrail(df).collect())


def test_skipped_answers_get_the_zero_evaluation(spark):
    df = evaluation(
        spark,
        {**LOW, "extra": ("", False)},
        {**LOW, "extra": ("text", True)},
        {**LOW, "extra": ("text", False)},
        schema=", content string, skip boolean",
    )
    out = policy.guard_llm_log(df, {"safety": 7.0}, skip_col="skip").collect()
    assert [(r.skipped, r.blocked, r.score) for r in out] == [(True, False, 0.0), (True, False, 0.0), (False, True, 4.0)]


def calls(spark, *rows):
    out = [(t, s, d, f"because {d}", safe, sug, '{"p":1}') for t, s, d, safe, sug in rows]
    schema = "tool_name string, score double, decision string, decision_reason string, d_safety double, suggested_params string, params string"
    df = spark.createDataFrame(out, schema)
    return df.withColumns({c: F.lit(None).cast("double") for c in DIM_COLUMNS if c not in df.columns})


def test_agent_policy_precedence(spark):
    df = calls(
        spark,
        ("a", 9.0, "BLOCK", 1.0, None),
        ("a", 9.0, "ALLOW", 1.0, None),
        ("a", 3.0, "FLAG", 9.0, None),
        ("a", 6.0, "FLAG", 9.0, None),
        ("a", 6.0, "ALLOW", 9.0, None),
        ("a", 9.0, "ALLOW", 9.0, None),
        ("b", 6.5, "ALLOW", 1.0, None),
        ("b", 4.5, "ALLOW", 1.0, None),
    )
    default = {"block_below": 4.0, "flag_below": 7.0, "dimension_minimums": {"safety": 2.0}}
    own = {"b": {"block_below": 5.0, "dimension_minimums": {"fairness": 9.0}}}
    out = policy.agent_policy(df, "block", default, own).collect()
    assert [(r.blocked, r.flagged, r.allowed) for r in out] == [
        (True, False, False), (True, False, False), (True, False, False), (False, True, False),
        (False, True, False), (False, False, True), (False, True, False), (True, False, False),
    ]
    assert [r.reason for r in out] == [
        "because BLOCK",
        "Dimension minimum violated: [safety]",
        "Score 3 is below block threshold 4",
        "because FLAG",
        "Score 6 is below flag threshold 7",
        "",
        "Score 6.5 is below flag threshold 7",
        "Score 4.5 is below block threshold 5",
    ]
    assert [r.halted for r in out] == [r.blocked for r in out]
    table = spark.createDataFrame(
        [("b", 5.0, None, [("fairness", 9.0)])],
        "tool_name string, block_below double, flag_below double, dimension_minimums array<struct<dim:string,min:double>>",
    )
    joined = policy.agent_policy(df, "block", default, table)
    assert sorted(r.reason for r in joined.collect()) == sorted(r.reason for r in out)


@pytest.mark.parametrize(
    "mode,params,executed",
    [("log_only", '{"p":1}', True), ("block", None, False), ("suggest_fix", '{"p":2}', True), ("auto_fix", '{"p":2}', True)],
)
def test_guard_swaps_parameters(spark, mode, params, executed):
    df = calls(spark, ("a", 9.0, "BLOCK", 9.0, '{"p":2}')).withColumn("result", F.lit("plain text"))
    r = policy.guard_calls(df, mode, result_col="result").first()
    assert (r.effective_params, r.executed) == (params, executed)
    assert r.scan_format == ("text" if executed else None)


def steps(spark, *plans):
    rows = [(p, i, d, s, 0.5) for p, ds in enumerate(plans) for i, (d, s) in enumerate(ds)]
    return spark.createDataFrame(rows, "plan_id int, step_index int, decision string, score double, credits double")


def test_plan_verdict(spark):
    df = steps(
        spark,
        [("ALLOW", 9.0), ("FLAG", 7.0)],
        [("BLOCK", 1.0), ("ALLOW", None), ("BLOCK", 8.0)],
        [("BLOCK", 5.0)],
        [("BLOCK", 5.0)] * 21,
    )
    out = {r.plan_id: r for r in plan_verdicts.plan_verdict(df).collect()}
    assert (out[0].overall_decision, out[0].overall_risk, out[0].plan_summary) == ("ALLOW_ALL", "low", "All 2 steps can proceed.")
    assert out[1].overall_decision == "PARTIAL_BLOCK" and out[1].blocked_indices == [0, 2]
    assert out[1].plan_summary == "1 of 3 steps can proceed. Blocked steps: [0, 2]."
    assert out[1].average_score == pytest.approx(3.0) and out[1].overall_risk == "high"
    assert (out[2].overall_decision, out[2].overall_risk) == ("BLOCK_ALL", "medium")
    assert out[2].plan_summary == "All 1 steps are blocked."
    assert out[3].error_code == "plan_too_long" and out[3].overall_decision is None and out[3].blocked_indices == []
    assert plan_verdicts.blocked_plans(plan_verdicts.plan_verdict(df)).count() == 2


def tools(spark, *rows):
    return spark.createDataFrame(rows, "tool_name string, source string, risk_level string")


def test_registry(spark):
    table = tools(spark, ("a", "system", "low"), ("b", "system", "medium"), ("b", "org_custom", "high"), ("c", "org_custom", "high"))
    eff = {r.tool_name: (r.source, r.risk_level) for r in registry.effective_registry(table).collect()}
    assert eff == {"a": ("system", "low"), "b": ("org_custom", "high"), "c": ("org_custom", "high")}
    used = registry.with_tool_profile(spark.createDataFrame([("b",), ("zzz",)], "tool_name string"), table)
    assert {r.tool_name: (r.profile_name, r.profile_risk_level) for r in used.collect()} == {"b": ("b", "high"), "zzz": ("generic", "low")}
    page = registry.list_tools(table, limit=2, offset=1).collect()
    assert [(r.tool_name, r.source, r.total, r.has_more) for r in page] == [("b", "org_custom", 4, True), ("b", "system", 4, True)]
    assert registry.list_tools(table, source="org_custom", risk_level="high", search="C").first().tool_name == "c"
    new = spark.createDataFrame([("b", "low", 1), ("b", "critical", 2), ("d", "low", 1), ("", "low", 1)], "tool_name string, risk_level string, registered_at int")
    after, rejected = registry.register_tools(table, new)
    out = {(r.tool_name, r.source): r.risk_level for r in after.collect()}
    assert [(r.tool_name, r.field) for r in rejected.collect()] == [("", "tool_name")]
    assert out == {
        ("a", "system"): "low", ("b", "system"): "medium", ("b", "org_custom"): "critical",
        ("c", "org_custom"): "high", ("d", "org_custom"): "low",
    }
    names = spark.createDataFrame([("b",), ("c",), ("x",), ("a",), (" ",), (None,)], "tool_name string")
    kept, report, rejected = registry.delete_tools(table, names)
    assert rejected.count() == 2
    assert sorted((r.tool_name, r.source) for r in kept.collect()) == [("a", "system"), ("b", "system")]
    assert sorted((r.tool_name, r.deleted, r.fallback) for r in report.collect()) == [
        ("a", False, "a"), ("b", True, "b"), ("c", True, "generic"), ("x", False, "generic"),
    ]


def test_watch_hits_and_assessment(spark):
    table = spark.createDataFrame(
        [("t", "org_custom", "critical", ["zip"], ["ssn"], (2.0, None))],
        "tool_name string, source string, risk_level string, proxy_variable_watch array<string>, pii_fields_watch array<string>, thresholds struct<block_below:double,flag_below:double>",
    )
    df = spark.createDataFrame(
        [("t", 9.0, '{"zip":1}', "general"), ("t", 9.0, '{"q":1}', "finance"), ("t", 9.0, '{"q":1}', "general"), ("u", 3.0, "{}", "general"), ("t", 3.0, "{}", "general")],
        "tool_name string, score double, params string, domain string",
    )
    out = registry.assess_tool_calls(df, table).collect()
    got = sorted((r.tool_name, r.score, r.params, r.domain, r.decision) for r in out)
    assert [g[-1] for g in got] == ["FLAG", "FLAG", "ALLOW", "BLOCK", "BLOCK"]


def test_observe_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("guard")
    out = policy.agent_policy(calls(spark, ("a", 9.0, "BLOCK", 9.0, None), ("a", 9.0, "ALLOW", 9.0, None)))
    policy.observe(out, seen).collect()
    assert seen.get["blocked"] == 1 and seen.get["allowed"] == 1 and seen.get["rows"] == 2
