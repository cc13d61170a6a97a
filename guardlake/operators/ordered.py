"""Skew-safe per-key ordered columns.

``Window.partitionBy(session)`` puts a whole session into one task.  That fails
when a single session holds a large share of all rows.  Here a key's rows are cut
into ordered chunks first:

1. Split points are picked among the rows whose hash falls on a fixed residue,
   about one in ``rows_per_chunk``.  They depend on row values only, so every
   branch of a plan and every retried task sees the same chunks.  Ordinary keys
   have none.
2. Windows run per ``(key, chunk)``.
3. For split keys only, each chunk is reduced to one summary row; a window over
   those few rows yields what a chunk must know about its neighbours.  The result
   holds at most one row per ``rows_per_chunk`` input rows and is broadcast back.

With no split points the second branch is empty and adaptive execution drops it.
"""

from dataclasses import dataclass, field

from pyspark.sql import Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
ROWS_PER_CHUNK = 1 << 20
ROWS_PER_CHUNK_CONF = "spark.guardlake.rowsPerChunk"
EVENING = 4
# Binary search over at most 2^21 - 1 split rows of a key, which 2^41 rows would fill at the default size.
_STEPS = [1 << k for k in range(20, -1, -1)]


def rows_per_chunk(df, override=None):
    """Chunk size: the argument, else the session setting, else the default."""
    if override is not None:
        return int(override)
    return int(df.sparkSession.conf.get(ROWS_PER_CHUNK_CONF, str(ROWS_PER_CHUNK)))


def split_points(df, keys, order, size):
    """One row per key that is cut: the key and its sorted array of split rows.

    Rows are picked four times as often and every fourth pick is kept, which
    evens out the chunks and leaves keys well below ``size`` rows whole.
    """
    at = F.struct(*order)
    picked = F.pmod(F.xxhash64(*keys, *order), F.lit(max(size // EVENING, 1))) == 0
    picks = df.where(picked).groupBy(*keys).agg(F.array_sort(F.collect_set(at)).alias("_picks"))
    kept = F.filter("_picks", lambda _, i: i % EVENING == EVENING - 1)
    return picks.select(*keys, kept.alias("_splits")).where(F.size("_splits") > 0)




def attach(left, right, keys, how):
    """Broadcast join on null-safe keys, keeping the left key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    cond = None
    for i, k in enumerate(keys):
        part = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        cond = part if cond is None else cond & part
    joined = left.join(F.broadcast(renamed), cond, how)
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


def _chunk_number(order):
    """Number of split rows at or before the row, by descending powers of two."""
    at = F.struct(*order)
    splits = F.col("_splits")
    steps = F.array(*[F.lit(s) for s in _STEPS])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda pos, step: F.when(F.get(splits, pos + step - 1) <= at, pos + step).otherwise(pos),
    )
    return F.when(splits.isNull(), F.lit(0)).otherwise(found)


@dataclass
class OrderedSpec:
    """What ``ordered_columns`` adds; all names map to new columns.

    ``number``/``total``: 1-based position and key size.
    ``lag``/``lead``: value of the previous / next row.
    ``first``: value of the key's first row.
    ``last_position``/``first_position``: position of the latest / earliest row
    strictly before this one that satisfies a condition.
    ``last_value``: value at the latest row, this one included, that satisfies a
    condition, as ``(condition, value)``.  ``next_value``: same, strictly after.
    """

    number: str | None = None
    total: str | None = None
    lag: dict = field(default_factory=dict)
    lead: dict = field(default_factory=dict)
    first: dict = field(default_factory=dict)
    last_position: dict = field(default_factory=dict)
    first_position: dict = field(default_factory=dict)
    last_value: dict = field(default_factory=dict)
    next_value: dict = field(default_factory=dict)


def with_chunks(df, keys, order, splits, how="left", *, cut_flag=None):
    """Add the chunk number of each row; ``how="inner"`` keeps rows of cut keys only.

    ``cut_flag`` names a column telling whether the row's key is cut.
    """
    joined = attach(df, splits, keys, how)
    if cut_flag:
        joined = joined.withColumn(cut_flag, F.col("_splits").isNotNull())
    if CHUNK not in df.columns:
        joined = joined.withColumn(CHUNK, _chunk_number(order))
    return joined.drop("_splits")


def ordered_columns(df, keys, order, *, splits=None, keep_chunk=False, chunk_rows=None, **spec):
    """Add ordered per-key columns (see :class:`OrderedSpec`) without ever placing a hot key in one task.

    ``order`` must make rows of a key distinct.  With ``keep_chunk`` the result
    keeps ``_chunk`` and stays partitioned by ``(keys, _chunk)``; a further call
    over the same keys and order then needs no shuffle if it is given the same
    ``splits`` (see :func:`split_points`).
    """
    spec = OrderedSpec(**spec)
    keys, order = list(keys), list(order)
    if splits is None:
        splits = split_points(df, keys, order, rows_per_chunk(df, chunk_rows))

    rows = df if CHUNK in df.columns else with_chunks(df, keys, order, splits)
    out = _local(rows, keys, order, spec)

    cut = with_chunks(df, keys, order, splits, "inner")
    carry = _carry(_local(cut, keys, order, spec), keys, order, spec)
    out = attach(out, carry, keys + [CHUNK], "left")
    return _combine(out, [c for c in df.columns if c != CHUNK], spec, keep_chunk)


def _windows(keys, order):
    part = Window.partitionBy(*keys, CHUNK)
    w = part.orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return part, w, before, upto, _later(part, order)


def _later(part, order):
    """Rows after this one, as a window over the reverse order.

    Spark works a frame up to the end of its group out anew for every row, while
    a frame from the start of the group only grows.
    """
    return part.orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)


def _local(rows, keys, order, spec):
    """Window columns that are right inside a chunk."""
    part, w, before, upto, after = _windows(keys, order)
    cols = {"_rn": F.row_number().over(w)}
    if spec.total:
        cols["_rows"] = F.count(F.lit(1)).over(part)
    if spec.lead:
        cols["_last"] = F.lead(F.lit(True)).over(w).isNull()
    for name, value in spec.lag.items():
        cols[f"_lag_{name}"] = F.lag(_col(value)).over(w)
    for name, value in spec.lead.items():
        cols[f"_lead_{name}"] = F.lead(_col(value)).over(w)
    for name, value in spec.first.items():
        cols[f"_first_{name}"] = F.first(_col(value)).over(upto)
    for name, (cond, value) in spec.last_value.items():
        cols[f"_lv_{name}"] = F.last(F.when(cond, _col(value)), ignorenulls=True).over(upto)
    for name, (cond, value) in spec.next_value.items():
        cols[f"_nv_{name}"] = F.last(F.when(cond, _col(value)), ignorenulls=True).over(after)
    out = rows.withColumns(cols)
    positions = {}
    for name, cond in spec.last_position.items():
        positions[f"_lp_{name}"] = F.max(F.when(cond, F.col("_rn"))).over(before)
    for name, cond in spec.first_position.items():
        positions[f"_fp_{name}"] = F.min(F.when(cond, F.col("_rn"))).over(before)
    return out.withColumns(positions) if positions else out


def _carry(local, keys, order, spec):
    """Summary row per chunk, then what each chunk takes over from its neighbours."""
    at = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, value in spec.lag.items():
        aggs.append(F.max_by(F.struct(_col(value).alias("v")), at).alias(f"_end_{name}"))
    for name, value in spec.lead.items():
        aggs.append(F.min_by(F.struct(_col(value).alias("v")), at).alias(f"_start_{name}"))
    for name, value in spec.first.items():
        aggs.append(F.min_by(F.struct(_col(value).alias("v")), at).alias(f"_head_{name}"))
    for name, cond in spec.last_position.items():
        aggs.append(F.max(F.when(cond, F.col("_rn"))).alias(f"_mx_{name}"))
    for name, cond in spec.first_position.items():
        aggs.append(F.min(F.when(cond, F.col("_rn"))).alias(f"_mn_{name}"))
    for name, (cond, value) in spec.last_value.items():
        aggs.append(F.max_by(_col(value), F.when(cond, at)).alias(f"_lvx_{name}"))
    for name, (cond, value) in spec.next_value.items():
        aggs.append(F.min_by(_col(value), F.when(cond, at)).alias(f"_nvx_{name}"))
    chunks = local.groupBy(*keys, CHUNK).agg(*aggs)

    per_key = Window.partitionBy(*keys)
    w = per_key.orderBy(CHUNK)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = _later(per_key, [CHUNK])
    chunks = chunks.withColumns(
        {
            "_offset": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_key_rows": F.sum("_n").over(per_key),
        }
    )
    cols = [F.col("_offset"), F.col("_key_rows")]
    for name in spec.lag:
        cols.append(F.lag(f"_end_{name}").over(w)["v"].alias(f"_c_lag_{name}"))
    for name in spec.lead:
        cols.append(F.lead(f"_start_{name}").over(w)["v"].alias(f"_c_lead_{name}"))
    for name in spec.first:
        cols.append(F.first(f"_head_{name}").over(w.rowsBetween(Window.unboundedPreceding, 0))["v"].alias(f"_c_first_{name}"))
    for name in spec.last_position:
        cols.append(F.max(F.col("_offset") + F.col(f"_mx_{name}")).over(before).alias(f"_c_lp_{name}"))
    for name in spec.first_position:
        cols.append(F.min(F.col("_offset") + F.col(f"_mn_{name}")).over(before).alias(f"_c_fp_{name}"))
    for name in spec.last_value:
        cols.append(F.last(f"_lvx_{name}", ignorenulls=True).over(before).alias(f"_c_lv_{name}"))
    for name in spec.next_value:
        cols.append(F.last(f"_nvx_{name}", ignorenulls=True).over(after).alias(f"_c_nv_{name}"))
    return chunks.select(*keys, CHUNK, *cols)


def _combine(out, base, spec, keep_chunk):
    offset = F.coalesce(F.col("_offset"), F.lit(0))
    at_start = F.col("_rn") == 1
    cols = [F.col(c) for c in base]
    if keep_chunk:
        cols.append(F.col(CHUNK))
    if spec.number:
        cols.append((F.col("_rn") + offset).cast("bigint").alias(spec.number))
    if spec.total:
        cols.append(F.coalesce("_key_rows", "_rows").cast("bigint").alias(spec.total))
    for name in spec.lag:
        cols.append(F.when(at_start, F.col(f"_c_lag_{name}")).otherwise(F.col(f"_lag_{name}")).alias(name))
    for name in spec.lead:
        cols.append(F.when(F.col("_last"), F.col(f"_c_lead_{name}")).otherwise(F.col(f"_lead_{name}")).alias(name))
    for name in spec.first:
        own = F.col(f"_first_{name}")
        cols.append(F.when(F.col(CHUNK) > 0, F.col(f"_c_first_{name}")).otherwise(own).alias(name))
    for name in spec.last_position:
        cols.append(F.coalesce(F.col(f"_lp_{name}") + offset, F.col(f"_c_lp_{name}")).alias(name))
    for name in spec.first_position:
        cols.append(F.coalesce(F.col(f"_c_fp_{name}"), F.col(f"_fp_{name}") + offset).alias(name))
    for name in spec.last_value:
        cols.append(F.coalesce(f"_lv_{name}", f"_c_lv_{name}").alias(name))
    for name in spec.next_value:
        cols.append(F.coalesce(f"_nv_{name}", f"_c_nv_{name}").alias(name))
    return out.select(*cols)


def _col(value):
    return F.col(value) if isinstance(value, str) else value
