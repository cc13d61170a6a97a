"""Data model: fixed vocabularies, column conventions and Spark schemas.

Hot-path tables keep the eight dimension scores as eight nullable DOUBLE
columns (``d_safety`` ... ``d_user_impact``) so that column pruning reaches the
Parquet scan.  The open-keyed form is ``MAP<STRING, DIMENSION_SCORE>``.
"""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Vocabularies and wire names that results must agree on.
# ---------------------------------------------------------------------------

DIMENSIONS = (
    "safety",
    "privacy",
    "fairness",
    "transparency",
    "accountability",
    "reliability",
    "inclusivity",
    "user_impact",
)
DIMENSION_ALIASES = {"legal_compliance": "inclusivity"}

FRAMEWORKS = ("gdpr", "ccpa", "hipaa", "eu_ai_act", "india_dpdp", "india_ai_gov")
FRAMEWORK_ALIASES = {
    "ai_act": "eu_ai_act",
    "euaia": "eu_ai_act",
    "dpdp": "india_dpdp",
    "ai_governance": "india_ai_gov",
    "india_ai": "india_ai_gov",
}

MODES = ("basic", "deep")
CONTENT_DOMAINS = ("general", "healthcare", "finance", "legal", "education", "code")
AGENT_DOMAINS = CONTENT_DOMAINS + ("hr",)
USE_CASES = (
    "general",
    "chatbot",
    "content_generation",
    "summarization",
    "translation",
    "code_generation",
)
SEVERITIES = ("low", "medium", "high", "critical")
POLICY_MODES = ("LOG_ONLY", "BLOCK", "REGENERATE", "CUSTOM")
AGENT_POLICY_MODES = ("block", "suggest_fix", "log_only", "auto_fix")

# Name of the overall score object in evaluation JSON, and the prefix of the
# score names written by the fan-out sink.
SCORE_FIELD = "rail_score"
SCORE_PREFIX = "rail_"

DEFAULT_THRESHOLD = 7.0
LOW_CONFIDENCE = 0.6
MIN_CONTENT = 10
MAX_CONTENT = 10_000
MAX_COMPLIANCE_CONTENT = 50_000
MAX_FRAMEWORKS = 5
MAX_PLAN_STEPS = 20
CACHE_TTL_SECONDS = 300
CACHED_ENDPOINTS = ("eval", "health")
REGENERATION_TTL_MINUTES = 15
TOO_HARMFUL_BELOW = 3.0

# ---------------------------------------------------------------------------
# Column conventions
# ---------------------------------------------------------------------------

DIM_COLUMNS = tuple(f"d_{d}" for d in DIMENSIONS)


def dim_column(dimension):
    """Flat column that holds one dimension's score."""
    return f"d_{dimension}"


# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

DIMENSION_SCORE = "STRUCT<score: DOUBLE, confidence: DOUBLE, explanation: STRING, issues: ARRAY<STRING>>"
DIMENSION_MAP = f"MAP<STRING, {DIMENSION_SCORE}>"
OVERALL = "STRUCT<score: DOUBLE, confidence: DOUBLE, summary: STRING>"
VIOLATION = (
    "STRUCT<framework: STRING, article: STRING, title: STRING, severity: STRING, "
    "description: STRING, remediation: STRING>"
)
CONTEXT_SIGNALS = (
    "STRUCT<tool_risk_level: STRING, proxy_variables_detected: ARRAY<STRING>, "
    "pii_fields_detected: ARRAY<STRING>, high_stakes_domain: BOOLEAN>"
)
THRESHOLDS = "STRUCT<block_below: DOUBLE, flag_below: DOUBLE, dimension_minimums: MAP<STRING, DOUBLE>>"

EVALUATION = (
    f"{SCORE_FIELD}: {OVERALL}, explanation: STRING, dimension_scores: {DIMENSION_MAP}, "
    "issues: ARRAY<STRUCT<dimension: STRING, description: STRING>>, "
    "improvement_suggestions: ARRAY<STRING>, from_cache: BOOLEAN"
)

AGENT_DECISION = (
    "decision: STRING, decision_reason: STRING, event_id: STRING, "
    f"{SCORE_FIELD}: {OVERALL}, dimension_scores: {DIMENSION_MAP}, "
    f"compliance_violations: ARRAY<{VIOLATION}>, "
    "policy: STRUCT<applied_rule: STRING, threshold_used: STRUCT<block_below: DOUBLE, flag_below: DOUBLE>, "
    "violated_dimensions: ARRAY<STRING>, source: STRING>, "
    f"context_signals: {CONTEXT_SIGNALS}, suggested_params: STRING, credits_consumed: DOUBLE, "
    "evaluation_depth: STRING, evaluated_at: STRING"
)

TOOL_RESULT = (
    "event_id: STRING, risk_level: STRING, recommended_action: STRING, "
    "pii_detected: STRUCT<found: BOOLEAN, entities: ARRAY<STRUCT<type: STRING, value: STRING, "
    "offset: INT, should_redact: BOOLEAN>>, redacted_result: STRING, compliance_flags: ARRAY<STRING>>, "
    "prompt_injection: STRUCT<detected: BOOLEAN, confidence: DOUBLE, patterns_checked: ARRAY<STRING>>, "
    f"{SCORE_FIELD}: STRUCT<score: DOUBLE, confidence: DOUBLE>, context_signals: {CONTEXT_SIGNALS}, "
    "redacted_available: BOOLEAN, credits_consumed: DOUBLE, evaluated_at: STRING"
)

INJECTION = (
    "event_id: STRING, injection_detected: BOOLEAN, confidence: DOUBLE, attack_type: STRING, "
    "severity: STRING, payload_preview: STRING, recommended_action: STRING, "
    "credits_consumed: DOUBLE, evaluated_at: STRING"
)

PLAN_STEP = (
    "step_index: INT, tool_name: STRING, decision: STRING, "
    f"{SCORE_FIELD}: {OVERALL}, dimension_scores: {DIMENSION_MAP}, "
    f"compliance_violations: ARRAY<{VIOLATION}>, suggested_params: STRING, "
    f"context_signals: {CONTEXT_SIGNALS}, credits_consumed: DOUBLE"
)

TOOL_PROFILE = (
    "tool_name: STRING, risk_level: STRING, evaluation_depth: STRING, source: STRING, "
    f"thresholds: {THRESHOLDS}, compliance_frameworks: ARRAY<STRING>, "
    "proxy_variable_watch: ARRAY<STRING>, pii_fields_watch: ARRAY<STRING>, description: STRING"
)

REQUIREMENT_RESULT = (
    "STRUCT<requirement_id: STRING, requirement: STRING, article: STRING, reference_url: STRING, "
    "status: STRING, score: DOUBLE, confidence: DOUBLE, threshold: DOUBLE, ai_specific: BOOLEAN, "
    "dimension_sources: ARRAY<STRING>, evaluation_method: STRING, issue: STRING, penalty_exposure: STRING>"
)
COMPLIANCE_ISSUE = (
    "STRUCT<id: STRING, description: STRING, dimension: STRING, severity: STRING, requirement: STRING, "
    "article: STRING, reference_url: STRING, remediation_effort: STRING, remediation_deadline_days: INT>"
)
COMPLIANCE = (
    "framework: STRING, framework_version: STRING, framework_url: STRING, evaluated_at: STRING, "
    "compliance_score: STRUCT<score: DOUBLE, confidence: DOUBLE, label: STRING, summary: STRING>, "
    f"dimension_scores: {DIMENSION_MAP}, requirements_checked: INT, requirements_passed: INT, "
    "requirements_failed: INT, requirements_warned: INT, "
    f"requirements: ARRAY<{REQUIREMENT_RESULT}>, issues: ARRAY<{COMPLIANCE_ISSUE}>, "
    "improvement_suggestions: ARRAY<STRING>, "
    "risk_classification_detail: STRUCT<tier: STRING, basis: STRING, obligations: ARRAY<STRING>>, "
    "from_cache: BOOLEAN, credits: DOUBLE"
)
MULTI_COMPLIANCE = (
    f"results: MAP<STRING, STRUCT<{COMPLIANCE}>>, "
    "cross_framework_summary: STRUCT<frameworks_evaluated: INT, average_score: DOUBLE, "
    "weakest_framework: STRING, weakest_score: DOUBLE, credits: DOUBLE>"
)

ITERATION = (
    "STRUCT<iteration: INT, content: STRING, scores: STRING, thresholds_met: BOOLEAN, "
    "failing_dimensions: ARRAY<STRING>, improvement_from_previous: DOUBLE, latency_ms: DOUBLE>"
)
REGENERATION = (
    "status: STRING, original_content: STRING, credits_consumed: DOUBLE, "
    "metadata: STRUCT<req_id: STRING, mode: STRING, total_iterations: INT, total_latency_ms: DOUBLE>, "
    "credits_breakdown: STRUCT<evaluations: DOUBLE, regenerations: DOUBLE, total: DOUBLE>, "
    "best_content: STRING, best_iteration: INT, "
    f"best_scores: STRUCT<{SCORE_FIELD}: {OVERALL}, dimension_scores: {DIMENSION_MAP}>, "
    f"iteration_history: ARRAY<{ITERATION}>, session_id: STRING, iteration: INT, "
    "iterations_remaining: INT, current_scores: STRING"
)

LLM_RESPONSE = {
    "choices": (
        "choices: ARRAY<STRUCT<message: STRUCT<content: STRING>>>, "
        "usage: STRUCT<prompt_tokens: BIGINT, completion_tokens: BIGINT, total_tokens: BIGINT>"
    ),
    "blocks": (
        "content: ARRAY<STRUCT<type: STRING, text: STRING>>, "
        "usage: STRUCT<input_tokens: BIGINT, output_tokens: BIGINT>"
    ),
    "candidates": (
        "response: STRUCT<candidates: ARRAY<STRUCT<content: STRUCT<parts: ARRAY<STRUCT<text: STRING>>>>>, "
        "usageMetadata: STRUCT<promptTokenCount: BIGINT, candidatesTokenCount: BIGINT>>, "
        "candidates: ARRAY<STRUCT<content: STRUCT<parts: ARRAY<STRUCT<text: STRING>>>>>, "
        "usageMetadata: STRUCT<promptTokenCount: BIGINT, candidatesTokenCount: BIGINT>"
    ),
}

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
