"""Policies and guards: verdicts are columns, nothing is raised per row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardlake.functions import failed_dimensions, failed_dimensions_by
from guardlake.operators.lookups import lookup_join, telling_columns
from guardlake.operators.scanning import scan_tool_results
from guardlake.schemas import DIM_COLUMNS

EMPTY = "array<string>"
THRESHOLD_TYPE = (
    "struct<block_below:double,flag_below:double,dimension_minimums:array<struct<dim:string,min:double>>>"
)


def js_number(c):
    """Number as text the way scores are quoted in reasons: 4, 4.5."""
    c = F.col(c) if isinstance(c, str) else c
    whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def _blocked_text(what, failed):
    return F.concat(F.lit(f"{what} blocked: dimensions ["), F.array_join(failed, ", "), F.lit("] below threshold"))


def enforce_policy(df, mode, thresholds, *, custom=None, regenerated=None, others=None):
    """Add ``passed, failed_dimensions, blocked, message, target_score, replacement``.

    ``custom`` is a column (or a function of the frame giving one) with the
    replacement in CUSTOM mode; an empty text means none.  ``regenerated`` is the
    same for REGENERATE mode: the best rewrite available for the row.  ``others`` names
    the map with dimensions beyond the eight columns.
    """
    failed = failed_dimensions(thresholds, others=others)
    out = df.withColumn("failed_dimensions", failed)
    bad = F.size("failed_dimensions") > 0
    null = F.lit(None).cast("string")
    blocked, message, target, replacement = F.lit(False), null, F.lit(None).cast("double"), null
    if mode == "BLOCK":
        blocked, message = bad, F.when(bad, _blocked_text("Content", F.col("failed_dimensions")))
    elif mode == "REGENERATE":
        target = F.when(bad, F.lit(float(max(thresholds.values()))))
        if regenerated is not None:
            replacement = F.when(bad, _value(regenerated, df))
    elif mode == "CUSTOM" and custom is not None:
        replacement = F.when(bad, F.nullif(_value(custom, df), F.lit("")))
    elif mode not in ("LOG_ONLY", "CUSTOM"):
        raise ValueError(f"unknown policy mode: {mode}")
    return out.withColumns(
        {
            "passed": ~bad,
            "blocked": blocked,
            "message": message,
            "target_score": target,
            "replacement": replacement,
        }
    )


def _value(column_or_function, df):
    return column_or_function(df) if callable(column_or_function) else column_or_function


def replace_failed(enforced, callback):
    """Fill ``replacement`` of failed rows from a Python or pandas function column.

    Such functions run for every row they meet, whatever condition stands around
    them, so failed rows are set apart first.  An empty text means none.
    """
    failed = enforced.where(~F.col("passed")).withColumn("replacement", F.nullif(callback, F.lit("")))
    return enforced.where("passed").unionByName(failed)


def split_blocked(df):
    """The rows that go on and the rows that were blocked."""
    return df.where(~F.col("blocked")), df.where("blocked")


def guardrail(df, thresholds=None, prefix="", others=None):
    """Add ``allowed`` and ``failed_dimensions`` (null when none); no thresholds allow all."""
    if thresholds is None:
        return df.withColumns({"allowed": F.lit(True), "failed_dimensions": F.lit(None).cast(EMPTY)})
    failed = failed_dimensions(thresholds, prefix, others)
    return df.withColumns(
        {"allowed": F.size(failed) == 0, "failed_dimensions": F.when(F.size(failed) > 0, failed)}
    )


def guard_turns(
    pairs, input_thresholds=None, output_thresholds=None, *, policy=None, custom=None, regenerated=None, output_col="out_text"
):
    """Input gate, then output gate or policy, over paired turns.

    Input scores are the ``d_*`` columns, output scores ``out_d_*``.  Adds
    ``stage`` (where it was blocked), ``blocked``, ``failed_dimensions``,
    ``message``, ``result``.  The policy looks at output thresholds only, and
    without them it does nothing.  A custom null keeps the output, an empty text
    replaces it.
    """
    none = F.array().cast(EMPTY)
    failed_in = failed_dimensions(input_thresholds) if input_thresholds else none
    failed_out = failed_dimensions(output_thresholds, "out_") if output_thresholds else none
    out = pairs.withColumns({"_in": failed_in, "_out": failed_out})
    bad_in = F.size("_in") > 0
    bad_out = ~bad_in & (F.size("_out") > 0)
    stops = policy in (None, "BLOCK")
    result = F.col(output_col)
    if policy == "REGENERATE" and regenerated is not None:
        better = F.nullif(_value(regenerated, pairs), F.lit(""))
        result = F.when(bad_out, F.coalesce(better, result)).otherwise(result)
    elif policy == "CUSTOM" and custom is not None:
        result = F.when(bad_out, F.coalesce(_value(custom, pairs), result)).otherwise(result)
    blocked = bad_in | (bad_out if stops else F.lit(False))
    what = "Output" if policy == "BLOCK" else "output"
    return out.withColumns(
        {
            "stage": F.when(bad_in, "input").when(bad_out & F.lit(stops), "output"),
            "blocked": blocked,
            "failed_dimensions": F.when(bad_in, F.col("_in")).otherwise(F.col("_out")),
            "message": F.when(bad_in, _blocked_text("input", F.col("_in"))).when(
                bad_out & F.lit(stops), _blocked_text(what, F.col("_out"))
            ),
            "result": F.when(~blocked, result),
        }
    ).drop("_in", "_out")


def guard_llm_log(df, thresholds=None, *, content_col="content", skip_col=None):
    """Gate logged model answers that carry scores.

    Skipped rows and empty contents get the zero evaluation: score and
    confidence 0, no dimensions, never blocked.
    """
    empty = F.coalesce(F.col(content_col), F.lit("")) == ""
    skip = empty | (F.coalesce(F.col(skip_col), F.lit(False)) if skip_col else F.lit(False))
    zeroed = {c: F.when(~skip, F.col(c)) for c in DIM_COLUMNS if c in df.columns}
    zeroed |= {c: F.when(skip, 0.0).otherwise(F.col(c)) for c in ("score", "confidence")}
    out = df.withColumns({"skipped": skip, **zeroed})
    failed = failed_dimensions(thresholds) if thresholds else F.array().cast(EMPTY)
    out = out.withColumn("failed_dimensions", failed)
    bad = F.size("failed_dimensions") > 0
    return out.withColumns(
        {"blocked": bad, "message": F.when(bad, _blocked_text("response", F.col("failed_dimensions")))}
    )


def _threshold_literal(t):
    """Thresholds given as a dict, as a struct column; a missing entry is null."""
    t = t or {}
    minimums = t.get("dimension_minimums")
    items = None
    if minimums is not None:
        items = F.array(*[F.struct(F.lit(d).alias("dim"), F.lit(float(m)).alias("min")) for d, m in minimums.items()])
    return F.struct(
        F.lit(t.get("block_below")).cast("double").alias("block_below"),
        F.lit(t.get("flag_below")).cast("double").alias("flag_below"),
        (items if items is not None else F.lit(None))
        .cast("array<struct<dim:string,min:double>>")
        .alias("dimension_minimums"),
    )


def with_thresholds(df, default=None, per_tool=None, *, tool_col="tool_name", id_cols=None):
    """Add ``thresholds``: each field of the tool's own entry, else the default's.

    ``per_tool`` is a dict for configurations, or a table ``(tool_name,
    block_below, flag_below, dimension_minimums)``, one row per tool, joined by
    tool name; calls of a hot tool are told apart by ``id_cols`` and spread.
    """
    base = _threshold_literal(default)
    own = F.lit(None).cast(THRESHOLD_TYPE)
    if isinstance(per_tool, DataFrame):
        table = per_tool.select(
            F.col("tool_name").alias(tool_col),
            F.struct("block_below", "flag_below", "dimension_minimums").cast(THRESHOLD_TYPE).alias("_own"),
        )
        default_ids = ["call_id"] if "call_id" in df.columns else telling_columns(df, [tool_col])
        df = lookup_join(df, table, [tool_col], list(id_cols) if id_cols else default_ids)
        own = F.col("_own")
    elif per_tool:
        cases = None
        for tool, t in per_tool.items():
            hit = F.col(tool_col) == tool
            cases = F.when(hit, _threshold_literal(t)) if cases is None else cases.when(hit, _threshold_literal(t))
        own = cases
    df = df.withColumns({"_own_t": own, "_base_t": base})
    merged = F.struct(
        *[
            F.coalesce(F.col(f"_own_t.{f}"), F.col(f"_base_t.{f}")).alias(f)
            for f in ("block_below", "flag_below", "dimension_minimums")
        ]
    )
    return df.withColumn("thresholds", merged).drop("_own_t", "_base_t", "_own")


def agent_policy(df, mode="log_only", default=None, per_tool=None, *, tool_col="tool_name"):
    """Add ``blocked, flagged, allowed, reason, violated_dimensions, halted``.

    In-session policies pass no ``per_tool``, so only the defaults apply.
    ``halted`` marks blocked calls in ``block`` mode, which do not run.
    """
    if isinstance(per_tool, DataFrame):
        df = with_thresholds(df, default, per_tool, tool_col=tool_col)
        t = F.col("thresholds")
        df = df.withColumn("violated_dimensions", failed_dimensions_by(t["dimension_minimums"]))
        block_below, flag_below = t["block_below"], t["flag_below"]
    else:
        # A configuration is known here, so each tool's rules become plain expressions.
        default = default or {}
        own = {tool: {**default, **limits} for tool, limits in (per_tool or {}).items()}

        def by_tool(value):
            cases = value(default)
            for tool, limits in own.items():
                cases = F.when(F.col(tool_col) == tool, value(limits)).otherwise(cases)
            return cases

        block_below, flag_below = (
            by_tool(lambda limits, f=f: F.lit(limits.get(f)).cast("double")) for f in ("block_below", "flag_below")
        )
        df = df.withColumn(
            "violated_dimensions", by_tool(lambda limits: failed_dimensions(limits.get("dimension_minimums") or {}))
        )
    violated = F.size("violated_dimensions") > 0
    score, decision = F.col("score"), F.col("decision")
    low = F.coalesce(score < block_below, F.lit(False))
    doubtful = F.coalesce(score < flag_below, F.lit(False))
    refused = decision.eqNullSafe(F.lit("BLOCK"))
    marked = decision.eqNullSafe(F.lit("FLAG"))
    blocked = refused | low | violated
    flagged = ~blocked & (marked | doubtful)

    def below(kind, bound):
        return F.concat(F.lit("Score "), js_number(score), F.lit(f" is below {kind} threshold "), js_number(bound))

    reason = (
        F.when(refused | (marked & flagged), F.coalesce(F.col("decision_reason"), F.lit("")))
        .when(
            violated,
            F.concat(F.lit("Dimension minimum violated: ["), F.array_join("violated_dimensions", ", "), F.lit("]")),
        )
        .when(low, below("block", block_below))
        .when(flagged, below("flag", flag_below))
        .otherwise("")
    )
    return df.withColumns(
        {
            "blocked": blocked,
            "flagged": flagged,
            "allowed": ~blocked & ~flagged,
            "reason": reason,
            "halted": blocked & F.lit(mode == "block"),
        }
    ).drop("thresholds")


def guard_calls(df, policy="log_only", *, thresholds=None, params_col="params", result_col=None):
    """Guarded calls: policy verdict, the parameters that are really used, whether the call ran.

    Blocked calls swap in the suggested parameters under ``auto_fix`` and
    ``suggest_fix``.  With ``result_col`` the answer is passed on for scanning as
    ``scan_text`` with ``scan_format`` ``text``, or ``json`` for an object, array
    or other JSON value.
    """
    out = agent_policy(df, policy, thresholds)
    swap = F.col("blocked") & F.col("suggested_params").isNotNull() & F.lit(policy in ("auto_fix", "suggest_fix"))
    out = out.withColumns(
        {
            "swapped": swap,
            "effective_params": F.when(F.col("halted"), F.lit(None).cast("string"))
            .when(swap, F.col("suggested_params"))
            .otherwise(F.col(params_col)),
            "executed": ~F.col("halted"),
        }
    )
    if result_col is None:
        return out
    scanned = F.col("executed") & F.col(result_col).isNotNull()
    as_json = F.try_parse_json(F.col(result_col)).isNotNull()
    return out.withColumns(
        {
            "scan_text": F.when(scanned, F.col(result_col)),
            "scan_format": F.when(scanned & as_json, "json").when(scanned, "text"),
        }
    )


def scan_results(guarded):
    """The calls of :func:`guard_calls` whose result goes on, with the findings in it."""
    return scan_tool_results(guarded.where(F.col("scan_text").isNotNull()), "scan_text")


def observe(df, name):
    """Count allowed, flagged and blocked rows while the job runs, as metrics of that name or ``Observation``."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if("blocked").alias("blocked"),
        *([F.count_if("flagged").alias("flagged")] if "flagged" in df.columns else []),
        *([F.count_if("allowed").alias("allowed")] if "allowed" in df.columns else []),
    )


__all__ = [
    "agent_policy",
    "enforce_policy",
    "guard_calls",
    "guard_llm_log",
    "guard_turns",
    "guardrail",
    "js_number",
    "observe",
    "replace_failed",
    "scan_results",
    "split_blocked",
    "with_thresholds",
]
