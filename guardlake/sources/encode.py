"""Scoring requests as JSON bodies.

Absent options and empty texts are left out; empty lists, empty objects and
false flags are kept.
"""

from pyspark.sql import functions as F

from guardlake.functions import resolve_framework

# Wire names of each endpoint's body in order.  "!" marks fields
# that are always sent, "?" fields left out only when null.
BODIES = {
    "eval": (
        "!content", "mode", "dimensions", "weights", "context", "domain", "usecase",
        "?include_explanations", "?include_issues", "?include_suggestions",
    ),
    "safe-regenerate": (
        "!content", "mode", "?max_regenerations", "regeneration_model", "thresholds", "context",
        "domain", "usecase", "user_query", "weights", "policy_hint",
    ),
    "safe-regenerate/continue": ("!session_id", "!regenerated_content"),
    "compliance/check": (
        "!content", "framework", "frameworks", "context", "?strict_mode", "?include_explanations",
    ),
    "agent/tool-call": (
        "!tool_name", "!tool_params", "domain", "mode", "agent_context", "compliance_frameworks",
        "custom_thresholds",
    ),
    "agent/tool-result": ("!tool_name", "!tool_result", "tool_params", "checks", "agent_context"),
    "agent/prompt-injection": ("!content", "content_source", "agent_context"),
    "agent/registry/tools": (
        "!tool_name", "!risk_level", "evaluation_depth", "thresholds", "compliance_frameworks",
        "proxy_variable_watch", "pii_fields_watch", "description",
    ),
}
JSON_FIELDS = ("tool_params", "tool_result", "policy_hint")


def encode_requests(df, endpoint):
    """Add ``endpoint`` and ``body`` built from the columns named after the body's fields.

    Columns the table lacks are left out.  JSON text in ``tool_params``,
    ``tool_result`` and ``policy_hint`` is embedded as JSON, field order as parsed.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fields = []
    for spec in BODIES[endpoint]:
        name = spec.lstrip("!?")
        if name not in types:
            continue
        value = F.col(name)
        if endpoint == "compliance/check":
            if name == "framework":
                value = resolve_framework(F.nullif(value, F.lit("")))
            elif name == "frameworks":
                single = F.col("framework") if "framework" in types else F.lit(None).cast("string")
                value = F.when(F.coalesce(single, F.lit("")) == "", F.transform(value, resolve_framework))
        elif name in JSON_FIELDS and types[name] == "string":
            value = F.try_parse_json(value)
        elif types[name] == "string" and not spec.startswith(("!", "?")):
            value = F.nullif(value, F.lit(""))
        fields.append(value.alias(name))
    return df.withColumns({"endpoint": F.lit(endpoint), "body": F.to_json(F.struct(*fields))})
