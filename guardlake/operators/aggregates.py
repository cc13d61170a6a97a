"""Score aggregations.  All are partial-then-final hash aggregates, so a hot
group is reduced before it is shuffled."""

from pyspark.sql import functions as F

from guardlake.functions import severity_level
from guardlake.schemas import DEFAULT_THRESHOLD, DIM_COLUMNS


def dimension_averages(df):
    """Mean of each dimension over the rows that have it."""
    return [F.avg(c).alias(f"avg_{c}") for c in DIM_COLUMNS if c in df.columns]


def aggregate_scores(df, *keys, rollup=False):
    """Mean, min, max, count overall and mean per dimension.

    Without keys an empty input yields no row.  ``rollup`` adds subtotals.
    """
    grouped = df.rollup(*keys) if rollup else df.groupBy(*keys)
    out = grouped.agg(
        F.avg("score").alias("average_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.count(F.lit(1)).alias("total_evaluations"),
        *dimension_averages(df),
    )
    return out if keys else out.where("total_evaluations > 0")


def _recorded(df):
    return df.where("recorded") if "recorded" in df.columns else df


def _zero_if_empty(out, keys, columns):
    return out if keys else out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def session_metrics(df, *keys, threshold=DEFAULT_THRESHOLD):
    """Mean, min, max, turns, per-dimension mean and passing rate in percent.

    Turns with ``recorded = false`` (input checks) are left out.  Without keys
    an empty input yields the zero row.
    """
    df = _recorded(df)
    turns = F.count(F.lit(1))
    out = df.groupBy(*keys).agg(
        F.avg("score").alias("average_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        turns.alias("turn_count"),
        (F.count_if(F.col("score") >= threshold) * F.lit(100.0) / F.nullif(turns, F.lit(0))).alias("passing_rate"),
        *dimension_averages(df),
    )
    return _zero_if_empty(out, keys, ["average_score", "min_score", "max_score", "passing_rate"])


def scores_summary(df, *keys, threshold=DEFAULT_THRESHOLD):
    """Turns, mean, lowest, turns below the threshold, regenerations (always 0)."""
    out = (
        _recorded(df)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("turns"),
            F.avg("score").alias("average_score"),
            F.min("score").alias("lowest_score"),
            F.count_if(F.col("score") < threshold).alias("below_threshold_count"),
            F.lit(0).cast("bigint").alias("regeneration_count"),
        )
    )
    return _zero_if_empty(out, keys, ["average_score", "lowest_score"])


def token_usage(df, *keys):
    """Totals of the three token counters."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("responses"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    )


def credits_breakdown(df, *keys, kind_col="kind", credits_col="credits"):
    """Credits of evaluations, of regenerations, and all."""
    kind, spent = F.col(kind_col), F.col(credits_col)
    return df.groupBy(*keys).agg(
        F.sum(F.when(kind == "evaluation", spent).otherwise(0.0)).alias("evaluations"),
        F.sum(F.when(kind == "regeneration", spent).otherwise(0.0)).alias("regenerations"),
        F.sum(spent).alias("total"),
    )


def issue_counts(df, *keys):
    """Issues by severity, with the log level each severity is written at."""
    return (
        df.groupBy(*keys, "severity")
        .agg(F.count(F.lit(1)).alias("issues"))
        .withColumn("level", severity_level("severity"))
    )
