"""Left join with a keyed lookup table that keeps a hot key's rows spread.

Adaptive skew handling does not reach joins whose lookup side is itself an
aggregate, so hot keys are salted here: rows of the left side are sampled by
hash, a key with many samples gets salts in proportion, its left rows pick one by
hash and its lookup row is repeated once per salt.  The table of hot keys holds
at most one row per ``rows_per_chunk`` left rows and is broadcast.
"""

from pyspark.sql import functions as F

from guardlake.operators.ordered import EVENING, attach, rows_per_chunk


def telling_columns(df, exclude):
    """Plain-valued columns other than ``exclude``, which together tell rows apart as well as the table can."""
    nested = ("array", "map", "struct", "variant")
    return [c for c, t in df.dtypes if c not in exclude and not t.startswith(nested)] or list(exclude)


def hot_keys(df, keys, spread_by, size):
    """Keys with clearly more than ``size`` rows, and how many salts each needs."""
    picked = F.pmod(F.xxhash64(*keys, *spread_by), F.lit(max(size // EVENING, 1))) == 0
    picks = df.where(picked).groupBy(*keys).agg(F.count(F.lit(1)).alias("_picks"))
    salts = F.floor(F.col("_picks") / EVENING).cast("int")
    return picks.select(*keys, salts.alias("_salts")).where(F.col("_salts") > 1)


def lookup_join(left, right, keys, spread_by, *, chunk_rows=None):
    """``left`` with the columns of ``right``, which has at most one row per key.

    ``spread_by`` names columns of ``left`` that tell a key's rows apart.
    """
    keys, spread_by = list(keys), list(spread_by)
    hot = hot_keys(left, keys, spread_by, rows_per_chunk(left, chunk_rows))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    rows = attach(left, hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
    table = attach(right, hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return rows.drop("_salts").join(table.drop("_salts"), [*keys, "_salt"], "left").drop("_salt")
