"""One job per operator group, each over whole given tables.

Results hold scalars only: lists are joined to text, means rounded to 8 digits.
"""

from functools import partial
from uuid import uuid4

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F

from guardlake import functions as C
from guardlake.operators import agent_sessions as agent
from guardlake.operators import aggregates, compliance, conversations, dedup, guarded, plan_verdicts, policy
from guardlake.operators import regeneration, registry, registry_pages, scanning, scoring, telemetry, validation
from guardlake.plans import fixtures as fx
from guardlake.schemas import CACHED_ENDPOINTS, DIM_COLUMNS, DIMENSIONS, LOW_CONFIDENCE, SCORE_FIELD, TOO_HARMFUL_BELOW
from guardlake.session import scratch_folder
from guardlake.sources import decode, encode, sinks

AS_OF = "2024-12-31 00:00:00"
THRESHOLDS = {"safety": 5.0, "privacy": 4.0, "user_impact": 6.0}


def r8(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 8)


def joined(c):
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")


def averages(prefix="avg_"):
    return [r8(f"{prefix}{c}").alias(f"{prefix}{c}") for c in DIM_COLUMNS]


# --- scalar functions ------------------------------------------------------


def score_bands(spark, sf):
    return fx.agent_calls(spark, sf).select(
        "call_id",
        C.score_label("score").alias("label"),
        C.score_color("score").alias("color"),
        C.score_grade("score").alias("grade"),
        C.risk_band("score").alias("risk"),
        C.is_passing("score").alias("passing"),
        r8(C.confidence_weighted("score", "confidence")).alias("weighted"),
    )


def names_and_aliases(spark, sf):
    names = F.array(*[F.lit(d) for d in (*DIMENSIONS, "legal_compliance")])
    frameworks = F.array(
        *[F.lit(f) for f in ("ai_act", "euaia", "dpdp", "ai_governance", "india_ai", "gdpr", "hipaa")]
    )
    severities = F.array(*[F.lit(s) for s in ("low", "medium", "high", "critical")])
    ev = fx.agent_calls(spark, sf).withColumns(
        {
            "raw_dimension": F.get(names, F.col("k") % 9),
            "raw_framework": F.get(frameworks, F.col("k") % 7),
            "severity": F.get(severities, F.col("k") % 4),
        }
    )
    return ev.select(
        "call_id",
        C.normalize_dimension("raw_dimension").alias("dimension"),
        C.format_dimension_name("raw_dimension").alias("display_name"),
        C.resolve_framework("raw_framework").alias("framework"),
        C.format_score("score", 1).alias("score_text"),
        C.format_score("score", 2).alias("score_text_2"),
        C.severity_level("severity").alias("level"),
        C.compliance_threshold(F.col("k") % 2 == 0).alias("threshold"),
    )


def content_previews(spark, sf):
    return fx.read(spark, sf, "documents").select(
        "doc_id",
        C.preview("text").alias("preview"),
        C.preview("text", 80, ellipsis=True).alias("log_preview"),
    )


# --- dimension and weight functions ----------------------------------------


def weighted_and_extremes(spark, sf):
    low, high = C.lowest_dimension(), C.highest_dimension()
    below = C.dimensions_below(7.0)
    return fx.agent_calls(spark, sf).select(
        "call_id",
        r8(C.weighted_score()).alias("equal_weighted"),
        r8(C.weighted_score({"safety": 50, "privacy": 50})).alias("two_weighted"),
        low["dimension"].alias("lowest"),
        low["score"].alias("lowest_score"),
        high["dimension"].alias("highest"),
        high["score"].alias("highest_score"),
        joined(F.transform(below, lambda e: e["dimension"])).alias("below"),
    )


def event_weights(spark, sf):
    shift = (F.col("call_id") % 7 - 3) / F.lit(2.0)
    scale = F.when(F.col("call_id") % 3 == 0, 100.0).otherwise(1.0)
    safety = F.col("k") / scale
    privacy = (100 - F.col("k") + shift) / scale
    none = F.col("k") == 0
    zero = F.lit(0.0)
    return fx.agent_calls(spark, sf).withColumn(
        "weights",
        F.create_map(
            F.lit("safety"), F.when(none, zero).otherwise(safety), F.lit("privacy"), F.when(none, zero).otherwise(privacy)
        ),
    )


def weight_normalization(spark, sf):
    rows = validation.annotate(event_weights(spark, sf), validation.nonzero_weight_rules("weights"))
    return rows.select(
        "call_id",
        r8(C.weights_sum("weights")).alias("total"),
        C.weights_sum_ok("weights").alias("accepted"),
        C.weights_sum_ok("weights", strict=True).alias("accepted_strict"),
        r8(C.normalize_weights("weights")["safety"]).alias("share_safety"),
        r8(C.normalize_weights_100("weights")["safety"]).alias("percent_safety"),
        "error_code",
    )


# --- validation ------------------------------------------------------------


def content_validation(spark, sf):
    docs = fx.read(spark, sf, "documents")
    return validation.annotate(docs, validation.content_rules("text")).select(
        "doc_id", "error_code", "error_message"
    )


def compliance_content_validation(spark, sf):
    """Which documents a compliance check takes, by the service's limit and by a narrower one."""
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    for name, rules in (("error", validation.compliance_content_rules("text")), ("narrow_error", validation.compliance_content_rules("text", 2000))):
        docs = validation.annotate(docs, rules).withColumnRenamed("error_code", name).drop("error_message")
    return docs.drop("text")


def rejected_content(spark, sf):
    _, rejected = validation.validate(fx.read(spark, sf, "documents"), validation.content_rules("text"))
    return rejected.select("doc_id", "n_chars", "error_code")


def request_validation(spark, sf):
    K, eid = F.col("k"), F.col("call_id")
    names = F.array(*[F.lit(f) for f in ("gdpr", "ccpa", "hipaa", "eu_ai_act", "india_dpdp", "india_ai_gov")])
    rows = event_weights(spark, sf).withColumns(
        {
            "framework": F.when(K % 5 == 0, "gdpr"),
            "frameworks": F.when(K % 5 != 1, F.slice(names, F.lit(1), (eid % 7).cast("int"))),
            "tool": F.when(K % 11 == 0, "").otherwise(F.col("tool_name")),
            "tool_params": F.when(K % 13 == 0, F.lit("7")).when(K % 13 == 1, F.lit("[1]")).otherwise(F.col("params")),
            "raw": F.when(K % 2 == 0, "x"),
            "data": F.when(K % 3 == 0, "{}"),
            "session": F.when(K % 17 != 0, "s"),
            "mode": F.when(K % 6 == 0, "fast").when(K % 6 == 1, "deep"),
            "domain": F.when(K % 7 == 0, "hr").when(K % 7 == 1, "code").otherwise(""),
            "usecase": F.when(K % 8 == 0, "poetry").otherwise("chatbot"),
            "framework_asked": F.when(K % 9 == 0, "sox").when(K % 9 == 1, "dpdp"),
            "frameworks_asked": F.when(K % 10 == 0, F.array(F.lit("ai_act"), F.lit("iso"))),
            "long_content": F.repeat(F.lit("x"), (K % 3) * 25_000 + (K % 2)),
            "content": F.when(K % 4 == 0, "  \t").otherwise("text"),
        }
    )

    checks = {
        "weights_error": validation.weight_rules("weights"),
        "framework_error": validation.framework_rules("framework", "frameworks"),
        "tool_error": validation.tool_call_rules("tool", "tool_params"),
        "result_error": validation.tool_result_rules("tool", "raw", "data"),
        "continue_error": validation.continue_rules("session", "content"),
        "option_error": validation.evaluation_option_rules(),
        "framework_name_error": validation.framework_name_rules("framework_asked", "frameworks_asked"),
        "compliance_error": validation.compliance_content_rules("long_content"),
    }
    for name, rules in checks.items():
        rows = validation.annotate(rows, rules).withColumnRenamed("error_code", name).drop("error_message")
    return rows.select("call_id", *checks)


# --- aggregates ------------------------------------------------------------


def aggregate_scores(spark, sf):
    out = aggregates.aggregate_scores(fx.agent_calls(spark, sf), "tool_name")
    return out.select(
        "tool_name", r8("average_score").alias("average_score"), "min_score", "max_score", "total_evaluations", *averages()
    )


def aggregate_scores_rollup(spark, sf):
    out = aggregates.aggregate_scores(fx.agent_calls(spark, sf), "tool_name", "decision", rollup=True)
    return out.select("tool_name", "decision", r8("average_score").alias("average_score"), "total_evaluations")


def conversation_metrics(spark, sf):
    turns = conversations.check_inputs(fx.turn_evaluations(spark, sf), F.col("role") == "system", ["safety"])
    out = aggregates.session_metrics(turns, "conv_id")
    return out.select(
        "conv_id",
        r8("average_score").alias("average_score"),
        "min_score",
        "max_score",
        "turn_count",
        r8("passing_rate").alias("passing_rate"),
        *averages(),
    )


def conversation_scores_summary(spark, sf):
    out = aggregates.scores_summary(fx.turn_evaluations(spark, sf), "conv_id")
    return out.select(
        "conv_id",
        "turns",
        r8("average_score").alias("average_score"),
        "lowest_score",
        "below_threshold_count",
        "regeneration_count",
    )


def input_checks(spark, sf):
    turns = conversations.check_inputs(fx.turn_evaluations(spark, sf), F.col("role") == "user", ["safety", "privacy"])
    return turns.select(
        "conv_id", "turn", "recorded", "mode", "d_safety", "d_fairness"
    )


def conversation_mode(spark, sf):
    out = conversations.conversation_mode(fx.turn_evaluations(spark, sf), "conv_id", ["turn"])
    return out.select("conv_id", "turn", "turn_number", "previous_score", "mode")


# --- guards and policies ---------------------------------------------------

TURN_CARRY = ("text", "score", "confidence", *DIM_COLUMNS)


def turn_pairs(spark, sf):
    return conversations.pair_turns(fx.turn_evaluations(spark, sf), "conv_id", ["turn"], carry=TURN_CARRY)


def guardrail_pairs(spark, sf):
    pairs = turn_pairs(spark, sf)
    plain = policy.guard_turns(pairs, {"safety": 3.0}, {"privacy": 4.0, "fairness": 3.0})
    gate = policy.guardrail(plain.drop("failed_dimensions"), {"safety": 3.0}).withColumnRenamed("allowed", "pre_allowed")
    return gate.select(
        "conv_id",
        "turn",
        "answered",
        "stage",
        "blocked",
        "message",
        "pre_allowed",
        joined("failed_dimensions").alias("pre_failed"),
        F.length("result").alias("result_chars"),
    )


def guard_turn_policies(spark, sf):
    pairs = turn_pairs(spark, sf).where("answered")
    limits = {"privacy": 4.0, "fairness": 3.0}
    options = {
        "BLOCK": {},
        "LOG_ONLY": {},
        "CUSTOM": {"custom": F.when(F.col("turn") % 2 == 0, F.lit(""))},
        "REGENERATE": {"regenerated": F.lit("rewritten")},
    }
    variants = {m: lambda df, m=m, o=o: policy.guard_turns(df, None, limits, policy=m, **o) for m, o in options.items()}
    out = side_by_side(pairs, variants, ["blocked", "message", "result"])
    return out.select(
        F.col("variant").alias("policy"), "conv_id", "turn", "blocked", "message", F.length("result").alias("result_chars")
    )


def side_by_side(df, variants, fields):
    """``df`` once per variant, with the fields the variant's function adds; read in one pass.

    ``variants`` maps a name to a function from frame to frame that keeps rows as they are.
    """
    kept, out = df.columns, df
    for i, add in enumerate(variants.values()):
        out = add(out).withColumnsRenamed({c: f"_{i}_{c}" for c in fields})
    entries = [
        F.struct(F.lit(name).alias("variant"), *[F.col(f"_{i}_{c}").alias(c) for c in fields])
        for i, name in enumerate(variants)
    ]
    return out.select(*kept, F.inline(F.array(*entries)))


def _union(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def policy_enforce(spark, sf):
    calls = fx.agent_calls(spark, sf)
    rewrite = F.when(F.col("k") % 2 == 0, F.concat(F.lit("rewrite "), F.col("call_id").cast("string"))).otherwise("")
    variants = {
        mode: lambda df, mode=mode: policy.enforce_policy(df, mode, THRESHOLDS, custom=rewrite, regenerated=rewrite)
        for mode in ("LOG_ONLY", "BLOCK", "REGENERATE", "CUSTOM")
    }
    fields = ["passed", "failed_dimensions", "blocked", "message", "target_score", "replacement"]
    out = side_by_side(calls, variants, fields).withColumn("failed", joined("failed_dimensions"))
    return out.select(F.col("variant").alias("mode"), "call_id", "failed", *[f for f in fields if f != "failed_dimensions"])


def agent_policy_check(spark, sf):
    out = policy.agent_policy(
        fx.agent_calls(spark, sf),
        "block",
        {"block_below": 4.0, "flag_below": 7.0, "dimension_minimums": {"safety": 2.0}},
        {
            "purchase": {"block_below": 6.0, "flag_below": 8.0, "dimension_minimums": {"fairness": 5.0, "privacy": 5.0}},
            "signup": {"flag_below": 9.5},
        },
    )
    return out.select(
        "call_id", "blocked", "flagged", "allowed", "halted", "reason", joined("violated_dimensions").alias("violated")
    )


def agent_session_policy(spark, sf):
    out = policy.agent_policy(fx.agent_calls(spark, sf), "log_only", {"block_below": 2.5, "flag_below": 6.5})
    return out.groupBy("session_id").agg(
        F.count_if("blocked").alias("blocked"), F.count_if("flagged").alias("flagged"), F.count_if("allowed").alias("allowed")
    )


def agent_guard_params(spark, sf):
    variants = {
        mode: lambda df, mode=mode: policy.guard_calls(df, mode, thresholds={"block_below": 4.0}, result_col="result")
        for mode in ("log_only", "block", "suggest_fix", "auto_fix")
    }
    fields = ["blocked", "swapped", "executed", "effective_params", "scan_format"]
    out = side_by_side(fx.calls_with_texts(spark, sf), variants, fields)
    return out.select(F.col("variant").alias("policy"), "call_id", *fields)


def agent_guard_scan(spark, sf):
    """Findings in the results that guarded calls pass on."""
    guarded_calls = policy.guard_calls(fx.calls_with_texts(spark, sf), "block", thresholds={"block_below": 4.0}, result_col="result")
    return policy.scan_results(guarded_calls).select(
        "call_id", "scan_format", "pii_found", "attack_type", "recommended_action", F.col("risk_level").alias("result_risk")
    )


def agent_policy_table(spark, sf):
    """Verdicts by thresholds that come as a table, a row per tool seen in the events."""
    tool = F.col("tool_name")
    tools = fx.read(spark, sf, "events").groupBy(F.col("event_type").alias("tool_name")).agg(F.count(F.lit(1)).alias("calls"))
    limits = tools.where(tool.isin("purchase", "signup", "click")).select(
        "tool_name",
        F.when(tool == "purchase", 6.0).when(tool == "click", 3.0).alias("block_below"),
        F.when(tool == "purchase", 8.0).when(tool == "signup", 9.5).alias("flag_below"),
        F.lit(None).cast("array<struct<dim:string,min:double>>").alias("dimension_minimums"),
    )
    out = policy.agent_policy(fx.agent_calls(spark, sf), "block", {"block_below": 4.0, "flag_below": 7.0}, limits)
    return out.select("call_id", "blocked", "flagged", "allowed", "halted")


def observed_policy(spark, sf):
    """Counts of verdicts, taken while the calls are written elsewhere."""
    seen = Observation("policy")
    out = policy.agent_policy(fx.agent_calls(spark, sf), "log_only", {"block_below": 2.5, "flag_below": 6.5})
    policy.observe(out, seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.get], "rows bigint, blocked bigint, flagged bigint, allowed bigint")


# --- agent sessions --------------------------------------------------------


def agent_mode(spark, sf):
    out = agent.agent_mode(fx.agent_calls(spark, sf), deep_every_n=7, escalate_after_flags=3, base_mode="basic")
    return out.select("call_id", "prior_calls", "flag_run", "mode")


def attempts(spark, sf):
    return agent.accept_calls(fx.agent_calls(spark, sf), max_calls=40, ttl_minutes=20 * 24 * 60)


def agent_accepted_prefix(spark, sf):
    return attempts(spark, sf).select("call_id", "accepted", "reject_reason")


def agent_accepted_no_block(spark, sf):
    out = agent.accept_calls(
        fx.agent_calls(spark, sf), max_calls=40, ttl_minutes=20 * 24 * 60, block_after_critical=False
    )
    return out.select("call_id", "accepted", "reject_reason")


def agent_session_status(spark, sf):
    rows = agent.accept_calls(
        fx.agent_calls(spark, sf), max_calls=50, ttl_minutes=29 * 24 * 60, block_after_critical=False
    )
    return agent.session_status(rows)


def agent_decision_counts(spark, sf):
    return agent.decision_counts(fx.agent_calls(spark, sf))


def agent_risk_summary(spark, sf):
    return risk_rows(agent.risk_summary(fx.agent_calls(spark, sf), AS_OF))


def risk_rows(summary):
    return summary.select(
        "session_id",
        "status",
        "total_tool_calls",
        "allowed",
        "flagged",
        "blocked",
        "critical_violations",
        "distinct_violations",
        r8("current_risk_score").alias("current_risk_score"),
        "risk_trend",
        *averages(),
        F.size("patterns").alias("patterns_detected"),
        joined(
            F.transform("exposure", lambda e: F.concat_ws(":", e["framework"], e["violations"], e["warnings"], e["risk_tier"]))
        ).alias("exposure"),
        "total_credits",
        "duration_seconds",
    )


def agent_closed_summary(spark, sf):
    """Final summary over the accepted calls only, as on closing a session."""
    out = agent.close_sessions(fx.agent_calls(spark, sf), AS_OF, max_calls=40, ttl_minutes=20 * 24 * 60)
    return out.select(
        "session_id", "status", "closed_at", "total_tool_calls", "risk_trend", "total_credits", "duration_seconds"
    )


def agent_risk_trend(spark, sf):
    out = agent.risk_trend(fx.agent_calls(spark, sf))
    return out.select("session_id", r8("current_risk_score").alias("current_risk_score"), "risk_trend")


def agent_exposure(spark, sf):
    return agent.compliance_exposure(fx.agent_calls(spark, sf))


def agent_patterns(spark, sf):
    return agent.detect_patterns(fx.agent_calls(spark, sf), AS_OF).drop("ordinal")


def session_event_log(spark, sf):
    calls = fx.agent_calls(spark, sf).select("session_id", "call_id", "ts", "tool_name", "score", "decision")
    conv = fx.read(spark, sf, "conversations")
    scans = scanning.scan_tool_results(conv.where(F.col("role") == "assistant"))
    when = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(secs=F.col("turn").cast("decimal(18,6)"))
    results = scans.select(
        F.col("conv_id").alias("session_id"), F.col("turn").alias("call_id"), when.alias("ts"), "recommended_action"
    )
    checks = scanning.check_injection(conv.where(F.col("role") == "user")).select(
        F.col("conv_id").alias("session_id"), F.col("turn").alias("call_id"), when.alias("ts"), "attack_type"
    )
    log = agent.session_event_log(calls, results, checks)
    return log.groupBy("session_id", "kind").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at")
    )


def history_since_reset(spark, sf):
    calls = fx.agent_calls(spark, sf)
    resets = calls.where(F.col("k") == 99).select("session_id", F.col("ts").alias("reset_at"))
    left = conversations.since_reset(calls, resets, "session_id")
    return left.groupBy("session_id").agg(F.count(F.lit(1)).alias("turns"), r8(F.avg("score")).alias("average_score"))


# --- plans -----------------------------------------------------------------


def plan_verdict(spark, sf):
    out = plan_verdicts.plan_verdict(fx.plan_steps(spark, sf))
    return out.select(
        "plan_id",
        "steps",
        "error_code",
        "overall_decision",
        "overall_risk",
        "plan_summary",
        r8("average_score").alias("average_score"),
        "credits",
    )


def plan_evaluation(spark, sf):
    steps = fx.plan_steps(spark, sf).drop("score", "decision", "credits")

    def scorer(rows):
        value = (F.col("call_id") * 13 + F.col("step_index") * 7) % 101 / F.lit(10.0)
        return rows.withColumns(
            {"score": value, "decision": F.when(value < 2.5, "BLOCK").otherwise("ALLOW"), "credits": F.lit(0.5)}
        )

    out = plan_verdicts.evaluate_plans(steps, scorer)
    return out.select(
        "plan_id", "steps", "error_code", "overall_decision", "overall_risk", joined(F.col("blocked_indices").cast("array<string>")).alias("blocked_indices")
    )


# --- tools -----------------------------------------------------------------


def tool_profiles(spark, sf):
    out = registry.with_tool_profile(fx.agent_calls(spark, sf), fx.event_tool_registry(spark, sf))
    return out.select(
        "call_id",
        "profile_name",
        "profile_risk_level",
        "profile_source",
        F.col("profile_thresholds.block_below").alias("block_below"),
    )


def tool_call_assessment(spark, sf):
    calls = fx.agent_calls(spark, sf).withColumn("domain", F.when(F.col("k") % 2 == 0, "finance").otherwise("general"))
    out = registry.assess_tool_calls(calls.drop("decision"), fx.event_tool_registry(spark, sf))
    return out.select(
        "call_id", joined("proxy_hits").alias("proxy_hits"), joined("pii_hits").alias("pii_hits"), "high_stakes", "block_below", "flag_below", "decision"
    )


def registry_page(spark, sf):
    return registry.list_tools(
        fx.tool_registry(spark, sf), limit=50, offset=10, source="org_custom", risk_level="high", search="RED"
    )


def registry_seek(spark, sf):
    """A filtered page and a deep one, from a registry written in ranges."""
    folder = scratch_folder(spark, "registry-pages")
    registry_pages.write_pages(fx.tool_registry(spark, sf), folder)
    some = registry_pages.seek_page(spark, folder, limit=50, offset=10, source="org_custom", risk_level="high", search="RED")
    deep = registry_pages.seek_page(spark, folder, limit=70, offset=120)
    return some.withColumn("page", F.lit("some")).unionByName(deep.withColumn("page", F.lit("deep")))


def registry_upsert(spark, sf):
    out, _ = registry.register_tools(
        fx.tool_registry(spark, sf),
        fx.tool_registrations(spark, sf),
        order_cols=("registered_at", "order_no", "line_no", "quantity", "description"),
    )
    return out.select("tool_name", "source", "risk_level")


def registry_delete(spark, sf):
    table = fx.tool_registry(spark, sf)
    doomed = table.where(F.col("risk_level") == "critical").unionByName(
        fx.read(spark, sf, "supplier").select(F.col("s_name").alias("tool_name")), allowMissingColumns=True
    )
    kept, report, _ = registry.delete_tools(table, doomed)
    left = kept.groupBy("source").agg(F.count(F.lit(1)).alias("tools"))
    return report.select("tool_name", "deleted", "fallback").unionByName(
        left.select(
            F.concat(F.lit("left:"), "source").alias("tool_name"), F.lit(False).alias("deleted"), F.col("tools").cast("string").alias("fallback")
        )
    )


# --- scanning and scoring --------------------------------------------------


def pii_scan(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    return scanning.pii_entities(docs, "doc_id").select(
        "doc_id", "type", "value", "offset", "should_redact"
    )


def pii_redact(spark, sf):
    return fx.read(spark, sf, "documents").select("doc_id", scanning.redact("text").alias("redacted"))


def tool_result_scan(spark, sf):
    out = scanning.scan_tool_results(fx.read(spark, sf, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "pii_found",
        F.size("entities").alias("entities"),
        joined("compliance_flags").alias("compliance_flags"),
        "attack_type",
        "recommended_action",
        "risk_level",
        F.length("redacted_text").alias("redacted_chars"),
    )


def injection_check(spark, sf):
    out = scanning.check_injection(fx.read(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "injection_detected", "attack_type", "severity", "injection_action", "injection_credits")


def rule_scorer(spark, sf):
    out = scoring.score(fx.document_signals(spark, sf))
    return out.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_token", "d_safety", "d_privacy", "d_reliability", "confidence", r8("score").alias("score")
    )


def low_confidence_upgrade(spark, sf):
    scored = scoring.score(fx.document_signals(spark, sf))
    out = scoring.upgrade_low_confidence(scored, below=LOW_CONFIDENCE)
    return out.select("doc_id", "mode", "upgraded", "confidence", "d_user_impact", r8("score").alias("score"))


def score_distinct(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    out = scoring.score_distinct(docs)
    return out.select("doc_id", "d_privacy", r8("score").alias("score"), "mode")


def length_model(texts, mode):
    """Stand-in for an outside model: scores from text length."""
    size = texts.str.len()
    confidence = 0.5 if mode == "basic" else 0.9
    return pd.DataFrame({"score": (size % 101) / 10.0, "confidence": confidence, "d_safety": (size % 11) * 1.0})


def plugin_scorer(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    out = scoring.score(docs, scorer=scoring.pandas_scorer(length_model), mode="deep")
    return out.select("doc_id", "score", "confidence", "d_safety", "d_privacy", "mode")


_SET_UPS = {}


def set_up_model(run):
    """Stand-in for a model that takes long to load; counts how often this worker loads it for a run of the job."""
    _SET_UPS[run] = _SET_UPS.get(run, 0) + 1
    return {"set_ups": _SET_UPS[run]}


def loaded_model(model, texts, mode):
    size = texts.str.len()
    confidence = 0.5 if mode == "basic" else 0.9
    return pd.DataFrame({"score": (size % 101) / 10.0, "confidence": confidence, "d_reliability": float(model["set_ups"])})


def model_scorer(spark, sf):
    """A model set up once per worker scores questions and, where those pass, answers; both calls share it."""
    scorer = scoring.model_scorer(partial(set_up_model, uuid4().hex), loaded_model, batch_bytes=10_000)
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    first = scoring.score_where(docs, F.col("doc_id") % 5 != 0, scorer=scorer)
    out = scoring.score_where(first, F.col("confidence") < LOW_CONFIDENCE, scorer=scorer, mode="deep", prefix="deep_")
    return out.select("doc_id", "score", "confidence", "deep_confidence", F.col("d_reliability").alias("set_ups"), F.col("deep_d_reliability").alias("deep_set_ups"))


def depth_model(df, text_col, mode):
    """Scores by text length, lower at full depth."""
    tenths = F.length(text_col) % (101 if mode == "basic" else 89)
    return df.withColumns({"score": tenths / F.lit(10.0), "confidence": F.lit(0.5 if mode == "basic" else 0.9)})


def conversation_scoring(spark, sf):
    """Turns scored at the depth that their number and the score before them ask for."""
    turns = fx.read(spark, sf, "conversations").select("conv_id", "turn", "text")
    out = conversations.score_conversations(turns, "conv_id", "turn", depth_model)
    return out.select("conv_id", "turn", "turn_number", "mode", "score", "confidence")


def conversation_scoring_chained(spark, sf):
    """The same without turns that are deep by their number; a third of the turns lie in one conversation."""
    turns = fx.read(spark, sf, "conversations").select("conv_id", "turn", "text")
    hot = (F.col("conv_id") * 8 + F.col("turn")) % 3 == 0
    turns = turns.select(F.when(hot, -1).otherwise(F.col("conv_id")).alias("conv_id"), F.col("conv_id").alias("part"), "turn", "text")
    out = conversations.score_conversations(turns, "conv_id", ["part", "turn"], depth_model, deep_every=0)
    return out.select("conv_id", "part", "turn", "turn_number", "mode", "score")


def custom_callback(spark, sf):
    @F.pandas_udf("string")
    def rewrite(texts: pd.Series) -> pd.Series:
        return texts.where(texts.str.len() % 2 == 0, "")

    scored = scoring.score(fx.read(spark, sf, "documents").select("doc_id", "text"))
    enforced = policy.enforce_policy(scored, "CUSTOM", {"privacy": 7.0, "safety": 6.0})
    return policy.replace_failed(enforced, rewrite("text")).select(
        "doc_id", "passed", joined("failed_dimensions").alias("failed"), "replacement"
    )


def evaluate_documents(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text", "lang")
    out = guarded.evaluate_and_aggregate(docs, "lang")
    return out.select(
        "lang", r8("average_score").alias("average_score"), "min_score", "total_evaluations", r8("avg_d_privacy").alias("avg_d_privacy")
    )


def guarded_conversations(spark, sf):
    turns = fx.read(spark, sf, "conversations")
    pairs = conversations.pair_turns(turns, "conv_id", ["turn"], carry=("text",))
    out = guarded.guard_conversations(pairs, {"privacy": 8.0}, {"privacy": 9.0, "user_impact": 6.0}, upgrade_below=LOW_CONFIDENCE)
    return out.select(
        "conv_id", "turn", "answered", "stage", "blocked", joined("failed_dimensions").alias("failed"), "out_confidence", "out_d_user_impact", F.length("result").alias("result_chars")
    )


def weighted_subset_scorer(spark, sf):
    out = scoring.score(
        fx.document_signals(spark, sf), mode="deep", dimensions=["privacy", "safety"], weights={"safety": 30, "privacy": 70}
    )
    return out.select("doc_id", r8("score").alias("score"), "d_safety", "d_privacy", "d_reliability", "mode")


def guarded_answers(spark, sf):
    rows = answers(spark, sf).select("conv_id", "turn", "blocks", (F.col("turn") % 3 == 0).alias("skip"))
    out = guarded.guard_answers(rows, "blocks", "blocks", {"privacy": 9.0}, skip_col="skip")
    return out.select("conv_id", "turn", "skipped", "blocked", r8("score").alias("score"), "d_privacy", "message", "total_tokens")


def traced_contents(spark, sf):
    docs = fx.read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("trace"), "text")
    return guarded.trace_contents(docs, "trace")


def regenerated_turns(spark, sf):
    """First answers that fail are replaced by the conversation's best rewrite."""
    rows = fx.candidates(spark, sf)
    first = rows.where(F.col("iteration") == 1)
    limits = {"safety": 6.0, "privacy": 5.0}
    offered = regeneration.attach_best(first, rows, "conv_id", max(limits.values()), max_iterations=5)
    out = policy.enforce_policy(offered, "REGENERATE", limits, regenerated=F.col("regenerated"))
    return out.select("conv_id", "passed", "target_score", F.length("replacement").alias("replacement_chars"))


# --- compliance ------------------------------------------------------------

REQUESTED = ("gdpr", "ccpa", "dpdp", "ai_act", "euaia")


def content_by_framework(spark, sf):
    return compliance.expand_frameworks(scoring.score(fx.document_signals(spark, sf)), REQUESTED)


def compliance_checks(spark, sf, strict=False):
    catalogue = compliance.requirement_catalogue(spark)
    return compliance.compliance_check(content_by_framework(spark, sf), "doc_id", catalogue, strict)


def compliance_matrix(spark, sf):
    out = compliance_checks(spark, sf)
    return out.withColumn("compliance_score", r8("compliance_score"))


def compliance_matrix_strict(spark, sf):
    out = compliance_checks(spark, sf, strict=True)
    return out.withColumn("compliance_score", r8("compliance_score"))


def cross_framework(spark, sf):
    out = compliance.cross_framework_summary(compliance_matrix(spark, sf), "doc_id")
    return out.withColumn("average_score", F.round("average_score", 6))


def found_issues(spark, sf):
    return compliance.compliance_issues(
        content_by_framework(spark, sf), "doc_id", compliance.requirement_catalogue(spark)
    )


def issue_counts(spark, sf):
    return aggregates.issue_counts(found_issues(spark, sf), "framework")


def top_issues(spark, sf):
    return compliance.top_issues(found_issues(spark, sf), "doc_id", 3).select(
        "doc_id", "rank", "issue_id", "severity", "dimension", "remediation_deadline_days"
    )


def compliance_log(spark, sf):
    return compliance.compliance_log(compliance_matrix(spark, sf), found_issues(spark, sf), "doc_id")


def risk_classification(spark, sf):
    domain = F.get(
        F.array(*[F.lit(d) for d in ("general", "healthcare", "finance", "code", "hr")]), F.col("call_id").cast("int") % 5
    )
    kind = F.get(
        F.array(*[F.lit(d) for d in ("automated", "assisted", "social_scoring", "fully_automated")]), F.col("k") % 4
    )
    rows = fx.agent_calls(spark, sf).withColumns({"domain": domain, "decision_type": kind})
    return compliance.risk_classification(rows).select("call_id", "tier", "basis", joined("obligations").alias("obligations"))


# --- regeneration ----------------------------------------------------------


def best_iteration(spark, sf):
    out = regeneration.select_best(fx.candidates(spark, sf), "conv_id", 8.0, max_iterations=3, harmful_below=TOO_HARMFUL_BELOW)
    return out.select(
        "conv_id",
        "status",
        "iterations_used",
        "iterations_remaining",
        "best_iteration",
        "best_score",
        F.length("best_text").alias("best_chars"),
    )


def iteration_history(spark, sf):
    out = regeneration.iteration_history(fx.candidates(spark, sf), "conv_id", 8.0, max_iterations=3)
    return out.select(
        "conv_id", "iteration", "score", "thresholds_met", r8("improvement_from_previous").alias("improvement_from_previous")
    )


def iteration_thresholds(spark, sf):
    """Rewrites judged by confidence and single dimensions as well as by the overall score."""
    limits = {"overall": {"score": 5.0, "confidence": 0.6}, "safety": {"score": 3.0}, "privacy": {"score": 6.0}}
    history = regeneration.iteration_history(fx.candidates(spark, sf), "conv_id", limits, max_iterations=4)
    best = regeneration.select_best(fx.candidates(spark, sf), "conv_id", limits, max_iterations=4, carry=())
    out = history.join(best.select("conv_id", "status", "best_iteration"), "conv_id")
    return out.select("conv_id", "iteration", "thresholds_met", joined("failing_dimensions").alias("failing"), "status", "best_iteration")


def regeneration_credits(spark, sf):
    history = regeneration.iteration_history(fx.candidates(spark, sf), "conv_id", 8.0, max_iterations=3)
    spent = history.select(
        "conv_id", F.explode(F.array(
            F.struct(F.lit("evaluation").alias("kind"), F.lit(1.0).alias("credits")),
            F.struct(F.lit("regeneration").alias("kind"), F.when(F.col("iteration") > 1, 1.5).otherwise(0.0).alias("credits")),
        )).alias("c")
    ).select("conv_id", "c.*")
    return aggregates.credits_breakdown(spent, "conv_id")


def expired_regenerations(spark, sf):
    base = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    minutes = F.col("iteration") * F.col("iteration") * 3 + F.col("conv_id") % 5
    rows = fx.candidates(spark, sf).withColumn(
        "ts", base + F.make_dt_interval(mins=minutes.cast("int"))
    )
    return regeneration.expired_sessions(rows, "conv_id")


def regeneration_sessions(spark, sf):
    return regeneration.regeneration_sessions(fx.regeneration_steps(fx.read(spark, sf, "events")))


# --- sinks -----------------------------------------------------------------


def scored_events(spark, sf):
    return scored_calls(fx.agent_calls(spark, sf))


def scored_calls(calls):
    return calls.withColumns(
        {
            "met": F.when(F.col("k") % 3 != 0, F.col("score") >= 7.0),
            "note": F.concat(F.lit("call "), F.col("call_id").cast("string")),
            "why": F.create_map(F.lit("safety"), F.concat(F.lit("k="), F.col("k").cast("string"))),
        }
    )


def score_fanout(spark, sf):
    return score_rows(scored_events(spark, sf))


def score_rows(scored):
    return sinks.score_fanout(
        scored,
        "call_id",
        threshold_met_col="met",
        comment_col="note",
        explanations_col="why",
        ids=("session_id",),
    )


def review_queue_rows(spark, sf):
    return sinks.review_items(
        scored_events(spark, sf), "call_id", "note", org="org", project="p", threshold=3.0, explanations_col="why"
    )


def review_queue(spark, sf):
    return review_queue_rows(spark, sf).drop("metadata", "incident_id")


def review_queue_sizes(spark, sf):
    return sinks.queue_sizes(review_queue_rows(spark, sf))


def review_pending(spark, sf):
    mark = "2024-01-10 00:00:00"
    queue = review_queue_rows(spark, sf)
    drained = sinks.queue_sizes(sinks.drain(queue, mark)).withColumn("part", F.lit("drained"))
    left = sinks.queue_sizes(sinks.pending(queue, drained_at=mark)).withColumn("part", F.lit("pending"))
    safety = sinks.queue_size(sinks.pending(queue, "safety", drained_at=mark)).select(
        F.lit("safety").alias("dimension"), "items", F.lit("pending safety").alias("part")
    )
    return drained.unionByName(left).unionByName(safety)


def incident_rows(calls):
    bad = policy.enforce_policy(calls, "LOG_ONLY", {"safety": 1.0, "privacy": 1.0}).where(~F.col("passed"))
    rows = bad.select(
        F.concat(F.lit("inc_"), F.col("call_id").cast("string")).alias("id"),
        F.lit("threshold_breach").alias("kind"),
        F.when(F.size("failed_dimensions") > 1, "high").otherwise("medium").alias("severity"),
        F.concat(F.lit("Low scores in "), "tool_name").alias("title"),
        F.col("failed_dimensions").alias("dims"),
        F.lit(1.0).alias("threshold"),
        "ts",
        F.create_map(F.lit("tool"), F.col("tool_name")).alias("metadata"),
    )
    return sinks.incidents(
        rows,
        id_col="id",
        type_col="kind",
        severity_col="severity",
        title_col="title",
        dimensions_col="dims",
        threshold_col="threshold",
        metadata_col="metadata",
    )


def incidents(spark, sf):
    return incident_columns(incident_rows(fx.agent_calls(spark, sf)))


def incident_columns(rows):
    return rows.select(
        "incident_id",
        "type",
        "severity",
        "status",
        "title",
        joined("affected_dimensions").alias("affected_dimensions"),
        "threshold",
        "timestamp",
        F.get_json_object("record", "$.tool").alias("record_tool"),
        F.get_json_object("record", "$.status").alias("record_status"),
    )


# --- telemetry and dedup ---------------------------------------------------


def request_log(spark, sf):
    return telemetry.request_log(fx.requests(spark, sf))


def request_metrics(spark, sf):
    out = telemetry.request_metrics(request_log(spark, sf), "mode")
    return out.withColumns({c: r8(c) for c in ("duration_avg", "score_avg")})


def request_histograms(spark, sf):
    log = request_log(spark, sf)
    scores = telemetry.histogram(log, "score", 1.0, "endpoint").withColumn("metric", F.lit("score.distribution"))
    times = telemetry.histogram(log, "duration_ms", 100.0, "endpoint").withColumn("metric", F.lit("request.duration"))
    return scores.unionByName(times).withColumn("kind", telemetry.metric_kind("metric"))


def request_errors(spark, sf):
    return telemetry.error_counts(request_log(spark, sf))


def request_dedup(spark, sf):
    rows = fx.requests(spark, sf).withColumn("key", dedup.request_key("endpoint", "body"))
    out = dedup.dedup_requests(
        rows, ["key"], ttl_seconds=3600, cacheable=F.col("endpoint").isin(*CACHED_ENDPOINTS), ok=F.col("error_type").isNull()
    )
    return out.select("request_id", "answer_id", "from_cache")


# --- decoding and encoding -------------------------------------------------


def decision_json(spark, sf):
    """Agent decisions as JSON text; fields are left out in a pattern to meet the defaults."""
    calls = fx.agent_calls(spark, sf)
    dims = F.map_from_entries(
        F.transform(
            C.dimension_entries(),
            lambda e: F.struct(e["dimension"], F.struct(e["score"].alias("score"), F.lit(0.5).alias("confidence"))),
        )
    )
    missing = F.col("k") % 9 == 0
    body = F.struct(
        "decision",
        F.when(~missing, F.col("decision_reason")).alias("decision_reason"),
        F.when(F.col("k") % 8 != 0, F.struct("score", "confidence")).alias(SCORE_FIELD),
        dims.alias("dimension_scores"),
        F.when(~missing, F.col("violations")).alias("compliance_violations"),
        F.when(~missing, F.struct(F.col("pii_fields").alias("pii_fields_detected"))).alias("context_signals"),
        F.try_parse_json("suggested_params").alias("suggested_params"),
        F.when(~missing, F.col("credits")).alias("credits_consumed"),
    )
    return calls.select("call_id", F.to_json(body).alias("json"))


def decode_decisions(spark, sf):
    out = decode.with_dimension_columns(decode.decode_agent_decision(decision_json(spark, sf), "json"))
    return out.select(
        "call_id",
        "decision",
        "decision_reason",
        "score",
        "confidence",
        "summary",
        *DIM_COLUMNS,
        F.size("violations").alias("violations"),
        F.get("violations", F.lit(0))["severity"].alias("first_severity"),
        joined("signals.pii_fields_detected").alias("pii_fields"),
        F.col("signals.high_stakes_domain").alias("high_stakes"),
        F.col("policy").isNull().alias("no_policy"),
        "suggested_params",
        "credits",
    )


def decode_evaluations(spark, sf):
    turns = fx.turn_evaluations(spark, sf)
    entry = F.transform(
        C.dimension_entries(),
        lambda e: F.struct(e["dimension"], F.struct(e["score"].alias("score"), F.lit(0.5).alias("confidence"))),
    )
    body = F.struct(
        F.struct("score", "confidence", F.col("role").alias("summary")).alias(SCORE_FIELD),
        F.col("text").alias("explanation"),
        F.map_from_entries(entry).alias("dimension_scores"),
        F.lit(False).alias("from_cache"),
    )
    out = decode.decode_evaluation(turns.select("conv_id", "turn", F.to_json(body).alias("json")), "json")
    return out.select("conv_id", "turn", "score", "confidence", "summary", F.length("explanation").alias("chars"), *DIM_COLUMNS, "from_cache")


def decode_scans(spark, sf):
    """Tool-result scans and injection checks written as JSON and read back."""
    docs = scanning.scan_tool_results(fx.read(spark, sf, "documents").select("doc_id", "text"))
    scan = F.struct(
        F.when(F.col("risk_level") != "low", F.col("risk_level")).alias("risk_level"),
        F.when(F.col("recommended_action") != "PASS", F.col("recommended_action")).alias("recommended_action"),
        F.when(
            F.col("pii_found"), F.struct(F.col("pii_found").alias("found"), "entities", "compliance_flags")
        ).alias("pii_detected"),
    )
    check = F.struct(
        F.when(F.col("injection_detected"), F.col("injection_detected")).alias("injection_detected"),
        F.when(F.col("injection_detected"), F.col("attack_type")).alias("attack_type"),
        F.col("injection_credits").alias("credits_consumed"),
    )
    rows = docs.select("doc_id", F.to_json(scan).alias("scan"), F.to_json(check).alias("check"))
    scans = decode.decode_tool_result(rows, "scan").select(
        "doc_id", "check", "risk_level", "recommended_action", "pii_found", F.size("entities").alias("entities"),
        joined("compliance_flags").alias("compliance_flags"),
    )
    return decode.decode_injection(
        scans.withColumnRenamed("recommended_action", "action").withColumnRenamed("risk_level", "risk"), "check"
    ).select(
        "doc_id", "risk", "action", "pii_found", "entities", "compliance_flags",
        "injection_detected", "attack_type", "severity", "credits",
    )


def decode_plan_steps(spark, sf):
    steps = fx.plan_steps(spark, sf)
    body = F.struct(
        "step_index",
        "tool_name",
        "decision",
        F.when(F.col("call_id") % 6 != 0, F.struct("score")).alias(SCORE_FIELD),
        F.col("credits").alias("credits_consumed"),
    )
    out = decode.decode_plan_step(steps.select("plan_id", "call_id", F.to_json(body).alias("json")), "json")
    return out.select("plan_id", "call_id", "step_index", "tool_name", "decision", "score", "credits")


def decode_tool_profiles(spark, sf):
    table = fx.tool_registry(spark, sf)
    body = F.struct(
        "tool_name",
        F.when(F.col("risk_level") != "low", F.col("risk_level")).alias("risk_level"),
        F.when(F.col("source") == "org_custom", F.col("source")).alias("source"),
        F.when(F.col("source") == "org_custom", F.struct(F.lit(4.0).alias("block_below"))).alias("thresholds"),
    )
    out = decode.decode_tool_profile(table.select(F.to_json(body).alias("json")), "json")
    return out.select("tool_name", "risk_level", "source", F.col("thresholds.block_below").alias("block_below"))


def decode_compliance_results(spark, sf):
    rows = compliance.evaluate_requirements(
        content_by_framework(spark, sf), compliance.requirement_catalogue(spark)
    )
    body = rows.groupBy("doc_id", "framework").agg(
        F.to_json(
            F.struct(
                F.first("framework").alias("framework"),
                F.count(F.lit(1)).alias("requirements_checked"),
                F.array_sort(
                    F.collect_list(F.struct("requirement_id", "article", "status", "threshold", "dimension_sources"))
                ).alias("requirements"),
            )
        ).alias("json")
    )
    out = decode.decode_compliance(body.drop("framework"), "json")
    return decode.explode_requirements(out, "doc_id", "framework", "requirements_checked").select(
        "doc_id", "framework", "requirements_checked", "requirement_id", "article", "status", "threshold"
    )


def decode_compliance_issues(spark, sf):
    """Issues written as JSON and read back, one row each."""
    issue = F.struct(F.col("issue_id").alias("id"), "severity", "dimension", "remediation_deadline_days")
    body = found_issues(spark, sf).groupBy("doc_id", "framework").agg(
        F.to_json(F.struct(F.first("framework").alias("framework"), F.array_sort(F.collect_list(issue)).alias("issues"))).alias("json")
    )
    out = decode.decode_compliance(body.drop("framework"), "json")
    return decode.explode_issues(out, "doc_id", "framework").select(
        "doc_id", "framework", F.col("id").alias("issue_id"), "severity", "dimension", "remediation_deadline_days"
    )


def json_log(spark, sf):
    """Calls written as JSON lines with some lines cut short, read back, and the good ones written and read as JSON."""
    folder = scratch_folder(spark, "json-log")
    line = F.to_json(F.struct("call_id", "decision", F.col("score").cast("double").alias("score")))
    cut = F.when(F.col("call_id") % 10 == 3, F.substring(line, 1, 12)).otherwise(line)
    sinks.append_lines(fx.agent_calls(spark, sf).select(cut.alias("line")), f"{folder}/lines")
    schema = "call_id BIGINT, decision STRING, score DOUBLE"
    rows = decode.read_json_log(spark, f"{folder}/lines", schema)
    bad = F.col("_corrupt_record").isNotNull()
    sinks.append_json(rows.where(~bad).drop("_corrupt_record"), f"{folder}/good")
    good = decode.read_json_log(spark, f"{folder}/good", schema).drop("_corrupt_record")
    broken = decode.read_text_log(spark, f"{folder}/lines").where(~F.col("value").endswith("}"))
    return good.unionByName(
        broken.select(F.lit(None).cast("bigint").alias("call_id"), F.col("value").alias("decision"), F.lit(None).cast("double").alias("score"))
    )


def decode_regenerations(spark, sf):
    history = regeneration.iteration_history(fx.candidates(spark, sf), "conv_id", 8.0, max_iterations=3)
    body = history.groupBy("conv_id").agg(
        F.to_json(
            F.struct(
                F.lit("passed").alias("status"),
                F.array_sort(
                    F.collect_list(
                        F.struct("iteration", F.col("text").alias("content"), "thresholds_met")
                    )
                ).alias("iteration_history"),
            )
        ).alias("json")
    )
    out = decode.decode_regeneration(body, "json")
    return decode.explode_iterations(out, "conv_id").select(
        "conv_id", "position", "iteration", F.length("content").alias("chars"), "thresholds_met"
    )


def answers(spark, sf):
    """Assistant turns as logged answers in the three formats."""
    turns = fx.read(spark, sf, "conversations").where(F.col("role") == "assistant")
    size = F.length("text")
    text = F.col("text")
    choices = F.struct(
        F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices"),
        F.struct(size.alias("prompt_tokens"), F.lit(7).alias("completion_tokens"), (size + 7).alias("total_tokens")).alias("usage"),
    )
    blocks = F.struct(
        F.array(
            F.struct(F.lit("text").alias("type"), text.alias("text")),
            F.struct(F.lit("tool_use").alias("type"), F.lit("x").alias("text")),
            F.struct(F.lit("text").alias("type"), F.lit("!").alias("text")),
        ).alias("content"),
        F.struct(size.alias("input_tokens"), F.lit(5).alias("output_tokens")).alias("usage"),
    )
    part = F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content")))
    nested = F.struct(
        F.struct(part.alias("candidates"), F.struct(size.alias("promptTokenCount")).alias("usageMetadata")).alias("response")
    )
    return turns.select(
        "conv_id", "turn", *[F.to_json(b).alias(n) for n, b in (("choices", choices), ("blocks", blocks), ("candidates", nested))]
    )


def decode_answers(spark, sf):
    rows = answers(spark, sf)
    parts = [
        decode.extract_llm_response(rows.select("conv_id", "turn", v), v, v).withColumn("vendor", F.lit(v))
        for v in ("choices", "blocks", "candidates")
    ]
    return _union(parts).drop("malformed")


def extracted_answers(spark, sf):
    return decode_answers(spark, sf).select(
        "vendor", "conv_id", "turn", F.length("content").alias("chars"), "prompt_tokens", "completion_tokens", "total_tokens"
    )


def token_usage(spark, sf):
    return aggregates.token_usage(decode_answers(spark, sf), "vendor")


def llm_guard(spark, sf):
    rows = fx.turn_evaluations(spark, sf).where(F.col("role") == "assistant").withColumns(
        {"content": F.when(F.col("turn") % 5 != 0, F.col("text")).otherwise(""), "skip": F.col("conv_id") % 4 == 0}
    )
    out = policy.guard_llm_log(rows, {"safety": 4.0}, skip_col="skip")
    return out.select("conv_id", "turn", "skipped", "blocked", "score", "confidence", "d_safety", "message")


def encode_requests(spark, sf):
    rows = fx.calls_with_texts(spark, sf).select(
        "call_id",
        F.col("opening").alias("content"),
        F.when(F.col("k") % 3 == 0, "deep").when(F.col("k") % 3 == 1, "").alias("mode"),
        F.when(F.col("k") % 5 == 0, F.array().cast("array<string>")).alias("dimensions"),
        F.when(F.col("k") % 2 == 0, F.lit(False)).alias("include_issues"),
    )
    return encode.encode_requests(rows, "eval").select("call_id", "endpoint", "body")


def encode_tool_calls(spark, sf):
    rows = fx.agent_calls(spark, sf).select(
        "call_id", "tool_name", F.col("params").alias("tool_params"), F.lit("").alias("domain")
    )
    return encode.encode_requests(rows, "agent/tool-call").select("call_id", "endpoint", "body")


def encode_compliance(spark, sf):
    rows = fx.calls_with_texts(spark, sf).select(
        "call_id",
        F.col("opening").alias("content"),
        F.when(F.col("k") % 2 == 0, "dpdp").alias("framework"),
        F.array(F.lit("ai_act"), F.lit("gdpr")).alias("frameworks"),
        F.when(F.col("k") % 4 == 0, F.lit(False)).alias("strict_mode"),
    )
    return encode.encode_requests(rows, "compliance/check").select("call_id", "endpoint", "body")


def encode_endpoints(spark, sf):
    """Bodies of the remaining endpoints for every call."""
    K = F.col("k")
    calls = fx.calls_with_texts(spark, sf)
    number = F.col("call_id").cast("string")
    bodies = {
        "safe-regenerate": {
            "content": F.col("opening"),
            "max_regenerations": K % 5,
            "regeneration_model": F.when(K % 2 == 0, "external"),
            "policy_hint": F.when(K % 3 == 0, '{"tone":"calm"}'),
        },
        "safe-regenerate/continue": {"session_id": number, "regenerated_content": F.col("opening")},
        "agent/tool-result": {
            "tool_name": F.col("tool_name"),
            "tool_result": F.concat(F.lit('{"data":'), F.col("params"), F.lit("}")),
            "checks": F.when(K % 2 == 0, F.array(F.lit("pii"))),
        },
        "agent/prompt-injection": {"content": F.col("opening"), "content_source": F.when(K % 2 == 0, "user_input").otherwise("")},
        "agent/registry/tools": {
            "tool_name": F.col("tool_name"),
            "risk_level": F.lit("high"),
            "thresholds": F.when(K % 2 == 0, F.struct(F.lit(4.5).alias("block_below"))),
        },
    }
    parts = [
        encode.encode_requests(calls.select("call_id", *[e.alias(n) for n, e in fields.items()]), endpoint).select(
            "call_id", "endpoint", "body"
        )
        for endpoint, fields in bodies.items()
    ]
    return _union(parts)


def decode_multi_compliance(spark, sf):
    """Multi-framework results written as JSON, read back one row per framework."""
    checks = compliance_matrix(spark, sf)
    result = F.struct(
        F.col("framework"),
        F.struct(F.col("compliance_score").alias("score"), F.col("label")).alias("compliance_score"),
        "requirements_checked",
    )
    body = checks.groupBy("doc_id").agg(
        F.to_json(
            F.struct(
                F.map_from_entries(F.collect_list(F.struct("framework", result.alias("result")))).alias("results"),
                F.struct(F.count(F.lit(1)).alias("frameworks_evaluated")).alias("cross_framework_summary"),
            )
        ).alias("json")
    )
    return decode.decode_multi_compliance(body, "json").select(
        "doc_id",
        F.col("framework_key").alias("framework"),
        F.col("compliance_score.score").alias("compliance_score"),
        F.col("compliance_score.label").alias("label"),
        "requirements_checked",
        F.col("summary.frameworks_evaluated").alias("frameworks_evaluated"),
    )


def cross_framework_log(spark, sf):
    summary = compliance.cross_framework_summary(compliance_matrix(spark, sf), "doc_id")
    return compliance.cross_framework_log(summary.withColumn("average_score", r8("average_score")), "doc_id")


def blocked_plans(spark, sf):
    out = plan_verdicts.blocked_plans(plan_verdicts.plan_verdict(fx.plan_steps(spark, sf)))
    return out.select("plan_id", "overall_decision", F.size("blocked_indices").alias("blocked"), "plan_summary")


BATCH = (
    score_bands,
    names_and_aliases,
    content_previews,
    weighted_and_extremes,
    weight_normalization,
    content_validation,
    compliance_content_validation,
    rejected_content,
    request_validation,
    aggregate_scores,
    aggregate_scores_rollup,
    conversation_metrics,
    conversation_scores_summary,
    input_checks,
    conversation_mode,
    guardrail_pairs,
    guard_turn_policies,
    policy_enforce,
    agent_policy_check,
    agent_session_policy,
    agent_guard_params,
    agent_guard_scan,
    agent_policy_table,
    observed_policy,
    agent_mode,
    agent_accepted_prefix,
    agent_accepted_no_block,
    agent_session_status,
    agent_decision_counts,
    agent_risk_summary,
    agent_closed_summary,
    agent_risk_trend,
    agent_exposure,
    agent_patterns,
    session_event_log,
    history_since_reset,
    plan_verdict,
    plan_evaluation,
    tool_profiles,
    tool_call_assessment,
    registry_page,
    registry_seek,
    registry_upsert,
    registry_delete,
    pii_scan,
    pii_redact,
    tool_result_scan,
    injection_check,
    rule_scorer,
    low_confidence_upgrade,
    score_distinct,
    plugin_scorer,
    model_scorer,
    conversation_scoring,
    conversation_scoring_chained,
    custom_callback,
    evaluate_documents,
    guarded_conversations,
    weighted_subset_scorer,
    guarded_answers,
    traced_contents,
    regenerated_turns,
    compliance_matrix,
    compliance_matrix_strict,
    cross_framework,
    issue_counts,
    top_issues,
    compliance_log,
    risk_classification,
    best_iteration,
    iteration_history,
    iteration_thresholds,
    regeneration_credits,
    expired_regenerations,
    regeneration_sessions,
    score_fanout,
    review_queue,
    review_queue_sizes,
    review_pending,
    incidents,
    request_log,
    request_metrics,
    request_histograms,
    request_errors,
    request_dedup,
    decode_decisions,
    decode_evaluations,
    decode_scans,
    decode_plan_steps,
    decode_tool_profiles,
    decode_compliance_results,
    decode_compliance_issues,
    json_log,
    decode_regenerations,
    extracted_answers,
    token_usage,
    llm_guard,
    encode_requests,
    encode_tool_calls,
    encode_compliance,
    encode_endpoints,
    decode_multi_compliance,
    cross_framework_log,
    blocked_plans,
)


def queries():
    return {f.__name__: f for f in BATCH}
