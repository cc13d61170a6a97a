"""Validation rules: rows are marked or split off, never failed.

The wording of the messages is a fixed value where callers are known to read it.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from guardlake.functions import is_blank, resolve_framework, weights_sum, weights_sum_ok
from guardlake.schemas import (
    CONTENT_DOMAINS,
    FRAMEWORKS,
    MAX_COMPLIANCE_CONTENT,
    MAX_CONTENT,
    MAX_FRAMEWORKS,
    MAX_PLAN_STEPS,
    MIN_CONTENT,
    MODES,
    USE_CASES,
)


@dataclass
class Rule:
    """A row passes when ``holds`` is true; null counts as a failure."""

    code: str
    holds: Column
    message: Column | str


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _lit(message):
    return F.lit(message) if isinstance(message, str) else message


def annotate(df, rules):
    """Add ``error_code`` and ``error_message`` of the first rule that fails, else null."""
    code = message = None
    for rule in rules:
        broken = ~F.coalesce(rule.holds, F.lit(False))
        text = _lit(rule.message)
        code = F.when(broken, rule.code) if code is None else code.when(broken, rule.code)
        message = F.when(broken, text) if message is None else message.when(broken, text)
    null = F.lit(None).cast("string")
    return df.withColumns(
        {
            "error_code": code if code is not None else null,
            "error_message": message if message is not None else null,
        }
    )


def validate(df, rules):
    """Split into valid rows and rejected rows; the latter carry code and message."""
    marked = annotate(df, rules)
    valid = marked.where(F.col("error_code").isNull()).drop("error_code", "error_message")
    return valid, marked.where(F.col("error_code").isNotNull())


def content_rules(c, min_len=MIN_CONTENT, max_len=MAX_CONTENT, what="Content"):
    """Content is not blank and its length is within bounds.

    A character takes one to four bytes, so most texts pass by their bytes and only the rest need counting.
    """
    c = _c(c)
    size, n_bytes = F.length(c), F.octet_length(c)
    return [
        Rule("empty_content", ~is_blank(c), f"{what} cannot be empty"),
        Rule(
            "content_too_short",
            (n_bytes >= 4 * min_len) | (size >= min_len),
            F.concat(F.lit(f"{what} needs at least {min_len} characters, has "), size.cast("string")),
        ),
        Rule(
            "content_too_long",
            (n_bytes <= max_len) | (size <= max_len),
            F.concat(F.lit(f"{what} allows at most {max_len} characters, has "), size.cast("string")),
        ),
    ]


def compliance_content_rules(c, max_len=MAX_COMPLIANCE_CONTENT):
    """Contents of compliance checks may be longer, and as short as one character."""
    return content_rules(c, 1, max_len)


def choice_rules(c, allowed, name):
    """A value, where given, is one of ``allowed``."""
    c = _c(c)
    message = F.concat(F.lit(f"Unknown {name}: "), F.coalesce(c.cast("string"), F.lit("")))
    return [Rule(f"unknown_{name}", c.isNull() | (c == "") | c.isin(*allowed), message)]


def evaluation_option_rules(mode_col="mode", domain_col="domain", usecase_col="usecase"):
    """Mode, domain and use case of a content evaluation are known ones."""
    return [
        *choice_rules(mode_col, MODES, "mode"),
        *choice_rules(domain_col, CONTENT_DOMAINS, "domain"),
        *choice_rules(usecase_col, USE_CASES, "usecase"),
    ]


def framework_name_rules(framework_col, frameworks_col):
    """Every requested framework, aliases resolved, is a known one; an unknown one would meet no requirement."""
    single, many = _c(framework_col), _c(frameworks_col)
    unknown = F.filter(
        F.concat(F.array(F.nullif(single, F.lit(""))), F.coalesce(many, F.array().cast("array<string>"))),
        lambda f: f.isNotNull() & ~resolve_framework(f).isin(*FRAMEWORKS),
    )
    return [Rule("unknown_framework", F.size(unknown) == 0, F.concat(F.lit("Unknown framework: "), F.array_join(unknown, ", ")))]


def continue_rules(session_col, content_col):
    """Continuing a regeneration needs a session id and new content."""
    return [
        Rule("session_id_required", _c(session_col) != "", "Session ID is required"),
        Rule("empty_content", ~is_blank(_c(content_col)), "Regenerated content cannot be empty"),
    ]


def weight_rules(c):
    """Weights, where given, add up to 100 within 1.0."""
    c = _c(c)
    return [
        Rule(
            "weights_sum",
            c.isNull() | weights_sum_ok(c),
            F.concat(F.lit("Weights must sum to 100. Current sum: "), weights_sum(c).cast("string")),
        )
    ]


def nonzero_weight_rules(c):
    return [Rule("weights_zero", weights_sum(c) != 0, "Weights cannot all be zero")]


def framework_rules(framework_col, frameworks_col, max_frameworks=MAX_FRAMEWORKS):
    """A single framework, or a list of one to ``max_frameworks``; the single one is looked at first."""
    single = F.coalesce(_c(framework_col) != "", F.lit(False))
    many = _c(frameworks_col)
    return [
        Rule("framework_required", single | many.isNotNull(), "Either framework or frameworks is required"),
        Rule("frameworks_empty", single | (F.size(many) >= 1), "At least one framework is required"),
        Rule(
            "frameworks_too_many",
            single | (F.size(many) <= max_frameworks),
            f"Maximum {max_frameworks} frameworks allowed per request",
        ),
    ]


def plan_rules(steps_col="steps", max_steps=MAX_PLAN_STEPS):
    """Over a table with one row per plan and its number of steps."""
    steps = _c(steps_col)
    return [
        Rule("plan_empty", steps >= 1, "plan must contain at least one step"),
        Rule("plan_too_long", steps <= max_steps, f"Plan exceeds maximum of {max_steps} steps"),
    ]


def tool_name_rules(name_col):
    return [Rule("tool_name_required", _c(name_col) != "", "toolName is required")]


def is_json_container(c):
    """JSON object or array."""
    c = _c(c)
    return F.coalesce(
        F.try_parse_json(c).isNotNull() & F.ltrim(c).rlike(r"^[{\[]"), F.lit(False)
    )


def tool_call_rules(name_col, params_col):
    """A tool name and parameters that are an object (arrays pass as well)."""
    return tool_name_rules(name_col) + [
        Rule("tool_params_object", is_json_container(params_col), "toolParams must be an object")
    ]


def tool_result_rules(name_col, raw_col, data_col):
    return tool_name_rules(name_col) + [
        Rule(
            "tool_result_empty",
            F.coalesce(_c(raw_col), _c(data_col)).isNotNull(),
            "toolResult must include at least one of: raw, data",
        )
    ]
