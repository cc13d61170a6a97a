"""Functions over weight maps (``MAP<STRING, DOUBLE>``)."""

from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def weights_sum(c):
    return F.aggregate(F.map_values(_c(c)), F.lit(0.0).cast("double"), lambda a, v: a + v)


def weights_sum_ok(c, strict=False):
    """Weights add up to 100: within 1.0, the bound itself allowed unless ``strict``."""
    off = F.abs(weights_sum(c) - F.lit(100.0))
    return off < 1.0 if strict else off <= 1.0


def normalize_weights(c):
    """Weights divided by their sum; null (a rejected row) when the sum is zero."""
    c = _c(c)
    total = weights_sum(c)
    return F.when(total != 0, F.transform_values(c, lambda _, v: v / total))


def normalize_weights_100(c):
    """Fractions that add up to one become percentages; other weights stay."""
    c = _c(c)
    total = weights_sum(c)
    is_fraction = F.abs(total - F.lit(1.0)) < 0.01
    return F.when(is_fraction, F.transform_values(c, lambda _, v: v * F.lit(100.0))).otherwise(c)
