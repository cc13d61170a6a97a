"""Agent sessions: depth choice, accepted prefix, risk summary, patterns, event log.

Input is a table of tool calls: ``session_id, call_id, ts, tool_name, score,
decision, pii_fields, violations, credits`` and the ``d_*`` columns.  Order is
``(ts, call_id)``.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from guardlake.functions import format_score
from guardlake.operators.ordered import CHUNK, ordered_columns
from guardlake.schemas import DIM_COLUMNS, DIMENSIONS

SESSION = ["session_id"]
ORDER = ["ts", "call_id"]
SCORE_WORD = "Score"


def is_critical():
    return F.exists(F.col("violations"), lambda v: v["severity"] == "critical")


def _touches_pii():
    return F.size(F.col("pii_fields")) > 0


def agent_mode(calls, *, deep_every_n=0, escalate_after_flags=3, base_mode=None, chunk_rows=None):
    """Add ``prior_calls``, ``flag_run`` (flags in a row just before) and ``mode``.

    ``base_mode`` is a column or literal used when neither rule fires; by default null.
    """
    not_flag = ~F.col("decision").eqNullSafe(F.lit("FLAG"))
    out = ordered_columns(
        calls, SESSION, ORDER, chunk_rows=chunk_rows, number="_n", last_position={"_clear": not_flag}
    )
    prior = F.col("_n") - 1
    run = prior - F.coalesce(F.col("_clear"), F.lit(0))
    mode = depth_rule(prior, run, deep_every_n, escalate_after_flags, base_mode)
    return out.withColumns({"prior_calls": prior, "flag_run": run, "mode": mode}).drop("_n", "_clear")


def accept_calls(
    calls, *, max_calls=100, ttl_minutes=720, block_after_critical=True, started_col=None, chunk_rows=None
):
    """Add ``accepted`` and ``reject_reason`` per attempted call.

    Reasons: ``max_tool_calls`` and ``ttl_expired`` close the session,
    ``critical_violation`` does not.  The call that carries the violation is
    itself accepted.  TTL runs from ``started_col`` or the first call.
    """
    spec = dict(number="_n", first_position={"_critical": is_critical()})
    if started_col is None:
        spec["first"] = {"_started": "ts"}
    rows = ordered_columns(calls, SESSION, ORDER, chunk_rows=chunk_rows, **spec)
    expired = F.col("ts") >= F.col(started_col or "_started") + ttl_interval(ttl_minutes)
    reason = reject_reason(F.col("_n"), F.col("_critical"), expired, max_calls, block_after_critical)
    return (
        rows.withColumn("reject_reason", reason)
        .withColumn("accepted", F.col("reject_reason").isNull())
        .drop("_n", "_critical", "_started")
    )


def ttl_interval(minutes):
    return F.expr(f"INTERVAL {int(minutes * 60)} SECONDS")


def reject_reason(n, critical_at, expired, max_calls, block_after_critical):
    """Why the ``n``-th attempt is refused, or null.

    ``critical_at`` is the position of the first earlier attempt with a critical
    violation.  Refused attempts do not count, so the number limit binds only if
    that many calls came before such a violation.
    """
    unblocked = F.coalesce(critical_at >= max_calls, F.lit(True)) if block_after_critical else F.lit(True)
    blocked = critical_at.isNotNull() if block_after_critical else F.lit(False)
    return (
        F.when((n > max_calls) & unblocked, "max_tool_calls")
        .when(expired, "ttl_expired")
        .when(blocked, "critical_violation")
    )


def close_sessions(calls, as_of, *, chunk_rows=None, **limits):
    """Final summary of every session over its accepted calls, with status and closing time."""
    attempts = accept_calls(calls, chunk_rows=chunk_rows, **limits)
    return risk_summary(
        attempts.where("accepted"), as_of, status=session_status(attempts), chunk_rows=chunk_rows
    )


def depth_rule(prior, run, deep_every_n, escalate_after_flags, base_mode):
    """Depth after ``prior`` calls of which the last ``run`` were flagged."""
    escalated = (run >= escalate_after_flags) if escalate_after_flags > 0 else F.lit(False)
    periodic = ((prior > 0) & (prior % deep_every_n == 0)) if deep_every_n > 0 else F.lit(False)
    base = F.lit(base_mode).cast("string") if not hasattr(base_mode, "alias") else base_mode
    return F.when(escalated | periodic, "deep").otherwise(base)


def session_status(attempts):
    """One row per session from :func:`accept_calls`: status, when closed, calls kept and refused."""
    closing = F.col("reject_reason").isin("max_tool_calls", "ttl_expired")
    return (
        attempts.groupBy(*SESSION)
        .agg(
            F.min("ts").alias("started_at"),
            F.min(F.when(closing, F.col("ts"))).alias("closed_at"),
            F.count_if("accepted").alias("accepted_calls"),
            F.count_if(~F.col("accepted")).alias("rejected_calls"),
        )
        .withColumn("status", F.when(F.col("closed_at").isNotNull(), "closed").otherwise("active"))
    )


def decision_counts(calls, *keys):
    """Calls in total, allowed, flagged, blocked."""
    return calls.groupBy(*(keys or SESSION)).agg(
        F.count(F.lit(1)).alias("total_tool_calls"),
        F.count_if(F.col("decision") == "ALLOW").alias("allowed"),
        F.count_if(F.col("decision") == "FLAG").alias("flagged"),
        F.count_if(F.col("decision") == "BLOCK").alias("blocked"),
    )


def compliance_exposure(calls):
    """Per session and framework: violations, warnings, distinct articles, risk tier."""
    found = (
        calls.where(F.size("violations") > 0)
        .select(*SESSION, F.inline("violations"))
        .select(
            *SESSION,
            "framework",
            "article",
            F.col("severity").isin("high", "critical").alias("serious"),
            (F.col("severity") == "critical").alias("critical"),
        )
    )
    per_article = found.groupBy(*SESSION, "framework", "article").agg(
        F.count_if("serious").alias("violations"),
        F.count_if(~F.coalesce(F.col("serious"), F.lit(False))).alias("warnings"),
        F.count_if("critical").alias("critical"),
    )
    violations, total = F.col("violations"), F.col("violations") + F.col("warnings")
    return (
        per_article.groupBy(*SESSION, "framework")
        .agg(
            F.sum("violations").alias("violations"),
            F.sum("warnings").alias("warnings"),
            F.sum("critical").alias("critical"),
            F.count(F.lit(1)).alias("articles"),
        )
        .withColumn("risk_tier", F.when(violations >= 3, "high").when(total >= 3, "medium").otherwise("low"))
    )


def risk_trend(calls, chunk_rows=None):
    """Per session: mean of the last five scores and the trend of the last three."""
    last = ordered_columns(calls, SESSION, ORDER, chunk_rows=chunk_rows, number="_n", total="_total")
    out = last.groupBy(*SESSION).agg(
        F.max("_total").alias("_calls"),
        F.avg(F.when(F.col("_n") > F.col("_total") - 5, F.col("score"))).alias("current_risk_score"),
        *[F.max(F.when(F.col("_n") == F.col("_total") - i, F.col("score"))).alias(f"_s{i}") for i in range(3)],
    )
    return out.select(*SESSION, "current_risk_score", _trend().alias("risk_trend"))


def _trend():
    a, b, c = F.col("_s2"), F.col("_s1"), F.col("_s0")
    return (
        F.when(F.col("_calls") < 3, "stable")
        .when(c <= 3.0, "critical")
        .when((c < b) & (b < a), "escalating")
        .when((c > b) & (b > a), "improving")
        .otherwise("stable")
    )


def _profile(calls, chunk_rows=None):
    """One row per session with everything the summary and the patterns need.

    One shuffle by ``(session, chunk)`` serves the windows and the first
    aggregate; later steps move one row per session, chunk and tool.
    """
    rows = ordered_columns(
        calls,
        SESSION,
        ORDER,
        chunk_rows=chunk_rows,
        keep_chunk=True,
        number="n",
        total="total",
        lag={"prev_score": "score"},
    )
    tool = Window.partitionBy(*SESSION, CHUNK, "tool_name").orderBy("n")
    rows = rows.withColumn("tool_next", F.lead("ts").over(tool))

    n, total, half = F.col("n"), F.col("total"), F.floor(F.col("total") / 2)
    blocked = F.col("decision") == "BLOCK"
    recent = n > total - 5
    sums = {
        "calls": F.count(F.lit(1)),
        "allowed": F.count_if(F.col("decision") == "ALLOW"),
        "flagged": F.count_if(F.col("decision") == "FLAG"),
        "blocked": F.count_if(blocked),
        "credits": F.sum("credits"),
        "recent_sum": F.sum(F.when(recent, F.col("score"))),
        "recent_n": F.count(F.when(recent, F.col("score"))),
        "drops": F.count_if(F.col("score") < F.col("prev_score")),
        "pii_calls": F.count_if(_touches_pii()),
    }
    picks = {f"_s{i}": F.max(F.when(n == total - i, F.col("score"))) for i in range(3)}
    picks["second_ts"] = F.max(F.when(n == 2, F.col("ts")))
    picks["half_ts"] = F.max(F.when(n == half + 1, F.col("ts")))
    firsts = {
        "started_at": F.min("ts"),
        "pii_first": F.min(F.when(_touches_pii(), F.col("ts"))),
    }
    for c in DIM_COLUMNS:
        early, late = F.when(n <= half, F.col(c)), F.when(n > half, F.col(c))
        sums |= {
            f"e_{c}": F.sum(early),
            f"en_{c}": F.count(early),
            f"l_{c}": F.sum(late),
            f"ln_{c}": F.count(late),
        }
        picks[f"has_{c}"] = F.max((n == 1) & F.col(c).isNotNull())

    per_chunk = rows.groupBy(*SESSION, CHUNK, "tool_name").agg(
        *[e.alias(k) for k, e in {**sums, **picks, **firsts}.items()],
        # Times rise with position, so plain minima belong to the first call and
        # to the first blocked call; they keep the aggregate on the hash path.
        F.min("ts").alias("tool_first"),
        F.min(F.when(blocked, n)).alias("block_n"),
        F.min(F.when(blocked, F.col("tool_next"))).alias("block_next"),
    )
    chunks = Window.partitionBy(*SESSION, "tool_name").orderBy(CHUNK)
    retry = F.coalesce(F.col("block_next"), F.lead("tool_first").over(chunks))
    per_chunk = per_chunk.withColumn("retry_at", F.when(F.col("block_n").isNotNull(), retry))

    def merge(names, fn):
        return [fn(k).alias(k) for k in names]

    per_tool = per_chunk.groupBy(*SESSION, "tool_name").agg(
        *merge(sums, F.sum), *merge(picks, F.max), *merge(firsts, F.min), *merge(["block_n", "retry_at"], F.min)
    )
    retried = F.when(
        F.col("retry_at").isNotNull(), F.struct(F.col("block_n").alias("n"), F.col("tool_name"), F.col("retry_at"))
    )
    return per_tool.groupBy(*SESSION).agg(
        *merge(sums, F.sum),
        *merge(picks, F.max),
        *merge(firsts, F.min),
        F.array_sort(F.collect_list(retried)).alias("retries"),
    ).withColumn("_calls", F.col("calls"))


def _pattern(name, description, severity, first_seen):
    return F.struct(
        F.lit(name).alias("pattern"),
        description.alias("description"),
        F.lit(severity).alias("severity"),
        first_seen.alias("first_seen"),
    )


def _patterns(as_of, score_word):
    """Array of the patterns found, in the order they are tested."""
    # The wording of the descriptions, but for ``score_word``.
    pii, calls = F.col("pii_calls"), F.col("calls")
    repeated = F.when(
        pii >= 3,
        _pattern(
            "repeated_pii_access",
            F.concat(F.lit("Tool accessed PII fields in "), pii, F.lit(" of "), calls, F.lit(" calls")),
            "high",
            F.col("pii_first"),
        ),
    )
    escalating = F.when(
        (calls >= 3) & (F.col("drops") >= 3),
        _pattern(
            "escalating_risk_scores",
            F.concat(F.lit(f"{score_word} dropped in "), F.col("drops"), F.lit(" consecutive calls")),
            "high",
            F.col("second_ts"),
        ),
    )
    retries = F.transform(
        F.col("retries"),
        lambda r: _pattern(
            "blocked_retry",
            F.concat(F.lit('Tool "'), r["tool_name"], F.lit('" was blocked and called again')),
            "medium",
            r["retry_at"],
        ),
    )
    accumulated = F.when(
        F.col("distinct_violations") > 3,
        _pattern(
            "compliance_accumulation",
            F.concat(
                F.col("distinct_violations"),
                F.lit(" distinct compliance violations accumulated across the session"),
            ),
            "high",
            as_of,
        ),
    )
    degraded = []
    for d, c in zip(DIMENSIONS, DIM_COLUMNS):
        drop = F.col(f"e_{c}") / F.nullif(F.col(f"en_{c}"), F.lit(0)) - F.col(f"l_{c}") / F.nullif(
            F.col(f"ln_{c}"), F.lit(0)
        )
        # Rounding hides the order in which a distributed sum adds up.
        drop = F.round(drop, 9)
        degraded.append(
            F.when(
                (calls >= 4) & F.col(f"has_{c}") & (drop >= 2.0),
                _pattern(
                    "dimension_degradation",
                    F.concat(
                        F.lit(f"Average {d} score dropped "), format_score(drop, 1), F.lit(" points over the session")
                    ),
                    "medium",
                    F.col("half_ts"),
                ),
            )
        )
    return F.concat(
        F.array_compact(F.array(repeated, escalating)),
        retries,
        F.array_compact(F.array(accumulated, *degraded)),
    )


def risk_summary(calls, as_of, *, status=None, chunk_rows=None, score_word=SCORE_WORD):
    """One row per session: counts, current risk, trend, dimension means,
    patterns, exposure, credits, duration.

    ``as_of`` (a timestamp column or literal) stands for the time of asking.
    ``status`` is the result of :func:`session_status`; without it sessions are active.
    ``score_word`` is what pattern texts call the score.
    """
    as_of = (F.lit(as_of) if not hasattr(as_of, "alias") else as_of).cast("timestamp_ntz")
    exposure = (
        compliance_exposure(calls)
        .groupBy(*SESSION)
        .agg(
            F.sum("articles").alias("distinct_violations"),
            F.sum("critical").alias("critical_violations"),
            F.array_sort(F.collect_list(F.struct("framework", "violations", "warnings", "risk_tier"))).alias("exposure"),
        )
    )
    out = _profile(calls, chunk_rows).join(exposure, SESSION, "left")
    out = out.withColumn("distinct_violations", F.coalesce("distinct_violations", F.lit(0)))
    if status is None:
        out = out.withColumns({"status": F.lit("active"), "closed_at": F.lit(None).cast("timestamp_ntz")})
    else:
        out = out.join(status.select(*SESSION, "status", F.col("closed_at").cast("timestamp_ntz")), SESSION, "left")
    upto = F.coalesce(F.col("closed_at"), as_of)
    averages = [
        (
            (F.coalesce(f"e_{c}", F.lit(0.0)) + F.coalesce(f"l_{c}", F.lit(0.0)))
            / F.nullif(F.col(f"en_{c}") + F.col(f"ln_{c}"), F.lit(0))
        ).alias(f"avg_{c}")
        for c in DIM_COLUMNS
    ]
    duration = F.timestamp_diff("SECOND", F.col("started_at").cast("timestamp_ntz"), upto)
    return out.select(
        *SESSION,
        "status",
        F.col("calls").alias("total_tool_calls"),
        "allowed",
        "flagged",
        "blocked",
        F.coalesce("critical_violations", F.lit(0)).alias("critical_violations"),
        "distinct_violations",
        F.coalesce(F.col("recent_sum") / F.nullif(F.col("recent_n"), F.lit(0)), F.lit(0.0)).alias("current_risk_score"),
        _trend().alias("risk_trend"),
        *averages,
        _patterns(as_of, score_word).alias("patterns"),
        F.coalesce(
            "exposure",
            F.array().cast("array<struct<framework:string,violations:bigint,warnings:bigint,risk_tier:string>>"),
        ).alias("exposure"),
        F.col("credits").alias("total_credits"),
        duration.alias("duration_seconds"),
        "started_at",
        "closed_at",
    )


def detect_patterns(calls, as_of, *, chunk_rows=None, score_word=SCORE_WORD):
    """One row per session and pattern, ``ordinal`` counting from 0."""
    found = risk_summary(calls, as_of, chunk_rows=chunk_rows, score_word=score_word)
    return found.select(*SESSION, F.posexplode("patterns").alias("ordinal", "p")).select(*SESSION, "ordinal", "p.*")


def session_event_log(calls, results, injections, *, track_results=True):
    """The three event kinds as one log; tool results only when tracked."""
    parts = [calls.withColumn("kind", F.lit("tool_call"))]
    if track_results:
        parts.append(results.withColumn("kind", F.lit("tool_result")))
    parts.append(injections.withColumn("kind", F.lit("injection")))
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part, allowMissingColumns=True)
    return log
