"""Choosing among rewrites of a content.  Texts are supplied, never generated."""

from collections.abc import Mapping

from pyspark.sql import Window
from pyspark.sql import functions as F

from guardlake.functions.dimensions import failed_dimensions
from guardlake.operators.ordered import ordered_columns
from guardlake.schemas import REGENERATION_TTL_MINUTES, TOO_HARMFUL_BELOW

MAX_REGENERATIONS = 5


def checked_limit(max_iterations):
    """Iterations allowed; the service takes 1 to 5."""
    if not 1 <= int(max_iterations) <= MAX_REGENERATIONS:
        raise ValueError(f"max_iterations must be between 1 and {MAX_REGENERATIONS}, not {max_iterations}")
    return int(max_iterations)


def _meets(target, others=None):
    """Columns: whether an iteration meets its thresholds, and the dimensions that fail.

    ``target`` is the least score, or a mapping as the service takes it, such as
    ``{"overall": {"score": 8.0, "confidence": 0.5}, "safety": {"score": 7.0}}``; a number
    stands for its score.  A missing confidence fails, an unscored dimension passes.
    """
    if not isinstance(target, Mapping):
        target = {"overall": target}
    limits = {name: low if isinstance(low, Mapping) else {"score": low} for name, low in target.items()}
    overall = limits.pop("overall", {})
    for name, low in [("overall", overall), *limits.items()]:
        unknown = set(low) - ({"score", "confidence"} if name == "overall" else {"score"})
        if unknown:
            raise ValueError(f"no threshold on {', '.join(sorted(unknown))} of {name}")
    met = F.col("score") >= overall["score"] if "score" in overall else F.lit(True)
    if "confidence" in overall:
        met &= F.coalesce(F.col("confidence") >= overall["confidence"], F.lit(False))
    failing = failed_dimensions({name: low["score"] for name, low in limits.items() if "score" in low}, others=others)
    if limits:
        met &= F.size(failing) == 0
    return met, failing


def iteration_history(candidates, key, target, *, max_iterations=5, others=None):
    """Iterations that were run, with ``thresholds_met``, ``failing_dimensions`` and ``improvement_from_previous``.

    ``target`` is the least score or a mapping of thresholds, see :func:`_meets`;
    ``others`` names the map with dimensions beyond the eight columns.

    ``candidates`` has one row per ``(key, iteration)`` counting from 1.  Rows
    past the limit are dropped first, so a key keeps at most five.
    """
    rows = candidates.where(F.col("iteration").between(1, checked_limit(max_iterations)))
    w = Window.partitionBy(key).orderBy("iteration")
    met, failing = _meets(target, others)
    done = F.max(met).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns(
        {
            "thresholds_met": met,
            "failing_dimensions": failing,
            "improvement_from_previous": F.col("score") - F.lag("score").over(w),
            "_done": F.coalesce(done, F.lit(False)),
        }
    )
    return rows.where(~F.col("_done")).drop("_done")


def select_best(candidates, key, target, *, max_iterations=5, carry=("text",), harmful_below=None, others=None):
    """One row per key: status, best iteration and its score and ``carry`` columns, iterations left.

    Passed when an iteration meets ``target``, as in :func:`iteration_history`; else the limit was reached, or
    another rewrite is awaited.  The best iteration has the highest score, the
    earlier one on a tie; none is considered after the first that passes.  With
    ``harmful_below`` a content whose first iteration, its own evaluation, scores less
    is refused: status ``too_harmful``, no iteration used, none left, no best one.
    """
    limit = checked_limit(max_iterations)
    rows = candidates.where(F.col("iteration").between(1, limit))
    met, _ = _meets(target, others)
    payload = F.struct("iteration", "score", *carry)
    out = rows.groupBy(key).agg(
        F.max("iteration").alias("_last"),
        F.min(F.when(met, F.col("iteration"))).alias("_first_met"),
        F.min_by(payload, F.when(met, F.col("iteration"))).alias("_passing"),
        F.max_by(payload, F.struct(F.col("score"), -F.col("iteration"))).alias("_highest"),
        F.min_by("score", "iteration").alias("_own_score"),
    )
    refused = F.lit(False)
    if harmful_below is not None:
        refused = F.coalesce(~not_too_harmful("_own_score", harmful_below), F.lit(False))
    best = F.when(~refused, F.coalesce("_passing", "_highest"))
    used = F.when(refused, 0).otherwise(F.coalesce("_first_met", "_last"))
    status = (
        F.when(refused, "too_harmful")
        .when(F.col("_first_met").isNotNull(), "passed")
        .when(F.col("_last") >= limit, "max_iterations_reached")
        .otherwise("awaiting_regeneration")
    )
    return out.select(
        key,
        status.alias("status"),
        used.alias("iterations_used"),
        F.when(refused, 0).otherwise(F.lit(limit) - used).alias("iterations_remaining"),
        best["iteration"].alias("best_iteration"),
        best["score"].alias("best_score"),
        *[best[c].alias(f"best_{c}") for c in carry],
    )


def attach_best(df, candidates, key, target, *, max_iterations=1, text_col="text", others=None):
    """Add ``regenerated``, the best rewrite supplied for each row's key, null where there is none."""
    best = select_best(candidates, key, target, max_iterations=max_iterations, carry=(text_col,), others=others)
    return df.join(best.select(key, F.col(f"best_{text_col}").alias("regenerated")), key, "left")


def not_too_harmful(c="score", below=TOO_HARMFUL_BELOW):
    """Content with a score under ``below`` cannot be regenerated."""
    return (F.col(c) if isinstance(c, str) else c) >= below


def expired_sessions(steps, key, ts="ts", minutes=REGENERATION_TTL_MINUTES):
    """Per key: last step and whether any step came more than ``minutes`` after the one before."""
    rows = ordered_columns(steps, [key], ["iteration", ts], lag={"_before": ts})
    late = F.col(ts) > F.col("_before") + F.expr(f"INTERVAL {int(minutes)} MINUTES")
    rows = rows.withColumn("_late", F.coalesce(late, F.lit(False)))
    return rows.groupBy(key).agg(
        F.max(ts).alias("last_step_at"),
        F.bool_or("_late").alias("expired"),
        F.min(F.when(F.col("_late"), F.col("iteration"))).alias("expired_at_iteration"),
    )


def regeneration_sessions(steps, key="session_id", ts="ts", *, minutes=REGENERATION_TTL_MINUTES):
    """One row per external session: ``outcome``, ``steps``, first and last step.

    A step more than ``minutes`` of event time after the one before starts another
    session.  A session passed if one of its steps has ``met``, else it expired.  The
    same on a stream, in append mode, for sessions that its watermark has passed.
    """
    gap = F.session_window(ts, f"{int(minutes)} minutes")
    out = steps.groupBy(key, gap.alias("_session")).agg(
        F.count(F.lit(1)).alias("steps"), F.bool_or("met").alias("_met"), F.min(ts).alias("first_step_at"), F.max(ts).alias("last_step_at")
    )
    outcome = F.when(F.col("_met"), "passed").otherwise("expired")
    return out.select(key, outcome.alias("outcome"), "steps", "first_step_at", "last_step_at")
