"""JSON logs to typed columns.

Each decoder parses one JSON text column with a fixed schema and applies the
defaults for missing fields.  ``malformed`` marks text that is missing, is no JSON
object or does not fit the schema; fields that could not be read hold the defaults.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from guardlake import schemas as S

ZERO = 0.0


def read_json_log(spark, path, schema, **options):
    """JSON-lines log as typed columns; bad lines land in ``_corrupt_record``."""
    full = T.DataType.fromDDL(f"STRUCT<{schema}, _corrupt_record: STRING>")
    return spark.read.schema(full).options(columnNameOfCorruptRecord="_corrupt_record", **options).json(path)


def read_text_log(spark, path):
    """One JSON document per line as a ``value`` column, for the decoders below."""
    return spark.read.text(path)


def _parse(df, json_col, schema):
    text = F.col(json_col)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_j", F.from_json(text, f"STRUCT<{schema}, _corrupt: STRING>", options))
    return parsed.withColumn("malformed", text.isNull() | F.col("_j._corrupt").isNotNull())


def _or(path, default):
    return F.coalesce(F.col(f"_j.{path}"), default if hasattr(default, "alias") else F.lit(default))


def _strings():
    return F.array().cast("array<string>")


def _signals(path):
    return F.struct(
        _or(f"{path}.tool_risk_level", "").alias("tool_risk_level"),
        _or(f"{path}.proxy_variables_detected", _strings()).alias("proxy_variables_detected"),
        _or(f"{path}.pii_fields_detected", _strings()).alias("pii_fields_detected"),
        _or(f"{path}.high_stakes_domain", False).alias("high_stakes_domain"),
    )


def _violations(path):
    fields = ("framework", "article", "title", "severity", "description", "remediation")
    filled = F.transform(
        F.col(f"_j.{path}"), lambda v: F.struct(*[F.coalesce(v[f], F.lit("")).alias(f) for f in fields])
    )
    return F.coalesce(filled, F.array().cast(f"array<{S.VIOLATION}>"))


def _dimensions(path="dimension_scores"):
    return F.coalesce(F.col(f"_j.{path}"), F.create_map().cast(S.DIMENSION_MAP))


def _emit(df, json_col, **columns):
    keep = [c for c in df.columns if c not in ("_j", json_col, "malformed")]
    return df.select(*keep, *[e.alias(n) for n, e in columns.items()], "malformed")


def decode_evaluation(df, json_col):
    """Evaluation result, dimension scores as a map and as flat columns."""
    out = _parse(df, json_col, S.EVALUATION)
    out = _emit(
        out,
        json_col,
        score=F.col(f"_j.{S.SCORE_FIELD}.score"),
        confidence=F.col(f"_j.{S.SCORE_FIELD}.confidence"),
        summary=F.col(f"_j.{S.SCORE_FIELD}.summary"),
        explanation=F.col("_j.explanation"),
        dimension_scores=F.col("_j.dimension_scores"),
        issues=F.col("_j.issues"),
        improvement_suggestions=F.col("_j.improvement_suggestions"),
        from_cache=F.col("_j.from_cache"),
    )
    return with_dimension_columns(out)


def with_dimension_columns(df, map_col="dimension_scores"):
    """Add the flat score columns of a dimension map."""
    m = F.col(map_col)
    return df.withColumns(
        {S.dim_column(d): F.try_element_at(m, F.lit(d))["score"] for d in S.DIMENSIONS}
    )


def decode_agent_decision(df, json_col):
    """Decision on a tool call."""
    out = _parse(df, json_col, S.AGENT_DECISION)
    policy = F.when(
        F.col("_j.policy").isNotNull(),
        F.struct(
            _or("policy.applied_rule", "").alias("applied_rule"),
            F.col("_j.policy.threshold_used.block_below").alias("block_below"),
            F.col("_j.policy.threshold_used.flag_below").alias("flag_below"),
            _or("policy.violated_dimensions", _strings()).alias("violated_dimensions"),
            _or("policy.source", "system_default").alias("source"),
        ),
    )
    return _emit(
        out,
        json_col,
        decision=F.col("_j.decision"),
        decision_reason=_or("decision_reason", ""),
        event_id=_or("event_id", ""),
        score=_or(f"{S.SCORE_FIELD}.score", ZERO),
        confidence=_or(f"{S.SCORE_FIELD}.confidence", ZERO),
        summary=_or(f"{S.SCORE_FIELD}.summary", ""),
        dimension_scores=_dimensions(),
        violations=_violations("compliance_violations"),
        policy=policy,
        signals=_signals("context_signals"),
        suggested_params=F.col("_j.suggested_params"),
        credits=_or("credits_consumed", ZERO),
        evaluation_depth=_or("evaluation_depth", ""),
        evaluated_at=_or("evaluated_at", ""),
    )


def decode_tool_result(df, json_col):
    """Scan of a tool's answer."""
    out = _parse(df, json_col, S.TOOL_RESULT)
    entities = F.transform(
        F.col("_j.pii_detected.entities"),
        lambda e: F.struct(
            F.coalesce(e["type"], F.lit("")).alias("type"),
            F.coalesce(e["value"], F.lit("")).alias("value"),
            F.coalesce(e["offset"], F.lit(0)).alias("offset"),
            F.coalesce(e["should_redact"], F.lit(False)).alias("should_redact"),
        ),
    )
    none = F.array().cast("array<struct<type:string,value:string,offset:int,should_redact:boolean>>")
    return _emit(
        out,
        json_col,
        event_id=_or("event_id", ""),
        risk_level=_or("risk_level", "low"),
        recommended_action=_or("recommended_action", "PASS"),
        pii_found=_or("pii_detected.found", False),
        entities=F.coalesce(entities, none),
        redacted_result=F.col("_j.pii_detected.redacted_result"),
        compliance_flags=_or("pii_detected.compliance_flags", _strings()),
        injection_detected=_or("prompt_injection.detected", False),
        injection_confidence=_or("prompt_injection.confidence", ZERO),
        patterns_checked=_or("prompt_injection.patterns_checked", _strings()),
        score=F.col(f"_j.{S.SCORE_FIELD}.score"),
        confidence=F.col(f"_j.{S.SCORE_FIELD}.confidence"),
        signals=_signals("context_signals"),
        redacted_available=_or("redacted_available", False),
        credits=_or("credits_consumed", ZERO),
        evaluated_at=_or("evaluated_at", ""),
    )


def decode_injection(df, json_col):
    """Prompt-injection check."""
    out = _parse(df, json_col, S.INJECTION)
    return _emit(
        out,
        json_col,
        event_id=_or("event_id", ""),
        injection_detected=_or("injection_detected", False),
        confidence=_or("confidence", ZERO),
        attack_type=_or("attack_type", "none"),
        severity=_or("severity", "none"),
        payload_preview=F.col("_j.payload_preview"),
        recommended_action=_or("recommended_action", "PASS"),
        credits=_or("credits_consumed", ZERO),
        evaluated_at=_or("evaluated_at", ""),
    )


def decode_plan_step(df, json_col):
    """Result of one plan step; an absent score counts as 0."""
    out = _parse(df, json_col, S.PLAN_STEP)
    return _emit(
        out,
        json_col,
        step_index=_or("step_index", 0),
        tool_name=_or("tool_name", ""),
        decision=F.col("_j.decision"),
        score=_or(f"{S.SCORE_FIELD}.score", ZERO),
        dimension_scores=_dimensions(),
        violations=_violations("compliance_violations"),
        suggested_params=F.col("_j.suggested_params"),
        signals=_signals("context_signals"),
        credits=_or("credits_consumed", ZERO),
    )


def decode_tool_profile(df, json_col):
    """Risk profile of a tool; thresholds and lists stay null when absent."""
    out = _parse(df, json_col, S.TOOL_PROFILE)
    return _emit(
        out,
        json_col,
        tool_name=_or("tool_name", ""),
        risk_level=_or("risk_level", "low"),
        evaluation_depth=F.col("_j.evaluation_depth"),
        source=_or("source", "system"),
        thresholds=F.col("_j.thresholds"),
        compliance_frameworks=F.col("_j.compliance_frameworks"),
        proxy_variable_watch=F.col("_j.proxy_variable_watch"),
        pii_fields_watch=F.col("_j.pii_fields_watch"),
        description=F.col("_j.description"),
    )


def decode_compliance(df, json_col):
    """Compliance result; children as arrays (see :func:`explode_requirements`)."""
    out = _parse(df, json_col, S.COMPLIANCE)
    return out.select(*[c for c in df.columns if c != json_col], "_j.*", "malformed").drop("_corrupt")


def decode_multi_compliance(df, json_col):
    """One row per framework of a multi-framework result, the summary's fields on each."""
    out = _parse(df, json_col, S.MULTI_COMPLIANCE)
    keep = [c for c in df.columns if c != json_col]
    rows = out.select(
        *keep, "malformed", F.col("_j.cross_framework_summary").alias("summary"), F.explode_outer("_j.results")
    )
    return rows.select(*keep, "malformed", F.col("key").alias("framework_key"), "summary", "value.*")


def explode_requirements(compliance, *keys):
    """One row per requirement of a decoded compliance result."""
    return compliance.select(*keys, F.inline_outer("requirements"))


def explode_issues(compliance, *keys):
    """One row per issue of a decoded compliance result."""
    return compliance.select(*keys, F.inline_outer("issues"))


def decode_regeneration(df, json_col):
    """Regeneration result; the history as an array (see :func:`explode_iterations`)."""
    out = _parse(df, json_col, S.REGENERATION)
    return out.select(*[c for c in df.columns if c != json_col], "_j.*", "malformed").drop("_corrupt")


def explode_iterations(regenerations, *keys):
    """One row per iteration in history order."""
    rows = regenerations.select(*keys, F.posexplode_outer("iteration_history").alias("position", "_it"))
    return rows.select(*keys, "position", "_it.*")


def extract_llm_response(df, json_col, vendor):
    """Text and token counters of a logged model answer.

    ``vendor`` names the answer format: ``choices`` (first choice's message),
    ``blocks`` (all text blocks joined), ``candidates`` (first part of the first
    candidate, top level or under ``response``).  Missing text is empty, missing
    counters are 0.
    """
    out = _parse(df, json_col, S.LLM_RESPONSE[vendor])
    zero = F.lit(0).cast("bigint")
    if vendor == "choices":
        content = F.get(F.col("_j.choices"), F.lit(0))["message"]["content"]
        prompt, completion = _or("usage.prompt_tokens", zero), _or("usage.completion_tokens", zero)
        total = _or("usage.total_tokens", zero)
    elif vendor == "blocks":
        texts = F.filter(F.col("_j.content"), lambda b: b["type"] == "text")
        content = F.array_join(F.transform(texts, lambda b: b["text"]), "")
        prompt, completion = _or("usage.input_tokens", zero), _or("usage.output_tokens", zero)
        total = prompt + completion
    elif vendor == "candidates":
        candidates = F.when(F.col("_j.response").isNotNull(), F.col("_j.response.candidates")).otherwise(
            F.col("_j.candidates")
        )
        part = F.get(F.get(candidates, F.lit(0))["content"]["parts"], F.lit(0))
        content = part["text"]

        def tokens(field):
            return F.coalesce(F.col(f"_j.response.usageMetadata.{field}"), F.col(f"_j.usageMetadata.{field}"), zero)

        prompt, completion = tokens("promptTokenCount"), tokens("candidatesTokenCount")
        total = prompt + completion
    else:
        raise ValueError(f"unknown answer format: {vendor}")
    return _emit(
        out,
        json_col,
        content=F.coalesce(content, F.lit("")),
        prompt_tokens=prompt,
        completion_tokens=completion,
        total_tokens=total,
    )
