"""Request log and request metrics."""

from pyspark.sql import functions as F

COUNTER_SUFFIXES = (".requests", ".errors", ".consumed")
UNINSTRUMENTED = ("health", "agent/tool-call")


def metric_kind(name):
    """Names ending in requests, errors or consumed are counters, others histograms."""
    name = F.col(name) if isinstance(name, str) else name
    is_counter = F.lit(False)
    for suffix in COUNTER_SUFFIXES:
        is_counter = is_counter | F.endswith(name, F.lit(suffix))
    return F.when(is_counter, "counter").otherwise("histogram")


def request_log(calls):
    """Rows of instrumented requests.  Health probes and tool-call checks are not instrumented.

    Failed requests keep endpoint, mode, duration and error type only.
    """
    ok = F.col("error_type").isNull()
    return calls.where(~F.col("endpoint").isin(*UNINSTRUMENTED)).select(
        "request_id",
        "ts",
        "endpoint",
        "mode",
        *[F.when(ok, F.col(c)).alias(c) for c in ("score", "confidence", "credits_consumed", "from_cache")],
        "duration_ms",
        "error_type",
    )


def request_metrics(log, *keys, quantiles=(0.5, 0.95)):
    """Requests, errors, duration and score figures per endpoint and further keys."""
    score, duration = F.col("score"), F.col("duration_ms")
    return log.groupBy("endpoint", *keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count("error_type").alias("errors"),
        F.sum("credits_consumed").alias("credits_consumed"),
        F.count_if("from_cache").alias("cache_hits"),
        F.min(duration).alias("duration_min"),
        F.max(duration).alias("duration_max"),
        F.avg(duration).alias("duration_avg"),
        *[F.percentile_approx(duration, q, 10000).alias(f"duration_p{round(q * 100)}") for q in quantiles],
        F.count(score).alias("scores"),
        F.avg(score).alias("score_avg"),
    )


def histogram(log, value_col, width, *keys):
    """Rows per ``keys`` and bucket ``[low, low + width)`` of a value."""
    low = F.floor(F.col(value_col) / F.lit(float(width))) * F.lit(float(width))
    return (
        log.where(F.col(value_col).isNotNull())
        .groupBy(*keys, low.alias("bucket_low"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def error_counts(log):
    """Errors by endpoint and type."""
    return log.where(F.col("error_type").isNotNull()).groupBy("endpoint", "error_type").agg(
        F.count(F.lit(1)).alias("errors")
    )
