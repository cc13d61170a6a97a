"""Functions over one row's dimension scores, held as flat ``d_*`` columns.

A null column means the dimension was not scored.  The order of ``DIMENSIONS``
breaks ties, so no map order is ever relied on.
"""

from pyspark.sql import functions as F

from guardlake.functions.bands import let
from guardlake.schemas import DEFAULT_THRESHOLD, DIM_COLUMNS, DIMENSIONS, dim_column


def _prefixed(dimension, prefix):
    return F.col(f"{prefix}{dim_column(dimension)}")


def dimension_columns(map_col, field="score"):
    """Flat columns from an open-keyed dimension map."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    return [F.try_element_at(m, F.lit(d))[field].alias(dim_column(d)) for d in DIMENSIONS]


def dimension_entries(prefix=""):
    """Array of ``(score, ordinal, dimension)`` for scored dimensions, in order."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    _prefixed(d, prefix).isNotNull(),
                    F.struct(
                        _prefixed(d, prefix).alias("score"),
                        F.lit(i).alias("ordinal"),
                        F.lit(d).alias("dimension"),
                    ),
                )
                for i, d in enumerate(DIMENSIONS)
            ]
        )
    )


def dimension_map(prefix=""):
    """``MAP<dimension, score>`` of scored dimensions."""
    return F.map_from_entries(
        F.transform(dimension_entries(prefix), lambda e: F.struct(e["dimension"], e["score"]))
    )


def _scored(dimension, prefix, others):
    """Score of a dimension: its flat column, or its entry in the map column ``others`` for names of the caller's own."""
    if dimension in DIMENSIONS:
        return _prefixed(dimension, prefix)
    if others is None:
        raise ValueError(f"dimension {dimension} has no column; name the map that holds it")
    return F.try_element_at(F.col(others) if isinstance(others, str) else others, F.lit(dimension))


def weighted_score(weights=None, prefix="", others=None):
    """Sum of score times weight.

    Without weights every scored dimension weighs 1/n.  A dimension missing from
    ``weights`` counts as 0, and weights are not normalised.  ``others`` is a
    ``MAP<dimension, score>`` with dimensions beyond the eight columns.
    """
    cols = {d: _prefixed(d, prefix) for d in DIMENSIONS}
    if weights is None:
        present = sum((c.isNotNull().cast("int") for c in cols.values()), F.lit(0))
        more = None
        if others is not None:
            more = F.filter(F.map_values(others), lambda s: s.isNotNull())
            present = present + F.coalesce(F.size(more), F.lit(0))
        share = F.lit(1.0) / F.nullif(present, F.lit(0))
        terms = [F.coalesce(c * share, F.lit(0.0)) for c in cols.values()]
        if more is not None:
            summed = F.aggregate(more, F.lit(0.0), lambda a, s: a + s)
            terms.append(F.coalesce(summed * share, F.lit(0.0)))
    else:
        # A weight for a dimension that no column holds meets no score.
        held = {d: w for d, w in weights.items() if d in cols or others is not None}
        terms = [F.coalesce(_scored(d, prefix, others) * F.lit(float(w)), F.lit(0.0)) for d, w in held.items()]
    total = F.lit(0.0)
    for term in terms:
        total = total + term
    return total


def lowest_dimension(prefix=""):
    """Struct ``(dimension, score)`` of the lowest score; the first one wins a tie."""
    best = F.array_min(dimension_entries(prefix))
    return F.struct(best["dimension"].alias("dimension"), best["score"].alias("score"))


def highest_dimension(prefix=""):
    """Struct ``(dimension, score)`` of the highest score; the first one wins a tie."""
    flipped = F.transform(
        dimension_entries(prefix), lambda e: F.struct(e["score"], -e["ordinal"], e["dimension"].alias("dimension"))
    )
    best = F.array_max(flipped)
    return F.struct(best["dimension"].alias("dimension"), best["score"].alias("score"))


def dimensions_below(threshold=DEFAULT_THRESHOLD, prefix=""):
    """Array of ``(score, ordinal, dimension)`` strictly below, lowest first, ties in order."""
    return F.array_sort(F.filter(dimension_entries(prefix), lambda e: e["score"] < F.lit(threshold)))


def failed_dimensions(thresholds, prefix="", others=None):
    """Names of dimensions scored strictly below their minimum, in threshold order.

    An unscored dimension passes.  A threshold on a dimension beyond the eight
    columns needs ``others``, the ``MAP<dimension, score>`` that holds it.
    """
    failing = [F.when(_scored(d, prefix, others) < F.lit(float(low)), F.lit(d)) for d, low in thresholds.items()]
    if not failing:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*failing))


def failed_dimensions_by(minimums, prefix=""):
    """Like :func:`failed_dimensions` with per-row minimums ``ARRAY<STRUCT<dim, min>>``."""
    minimums = F.col(minimums) if isinstance(minimums, str) else minimums
    failing = let(
        dimension_map(prefix),
        lambda scores: F.filter(
            minimums, lambda m: F.coalesce(F.try_element_at(scores, m["dim"]) < m["min"], F.lit(False))
        ),
    )
    return F.coalesce(F.transform(failing, lambda m: m["dim"]), F.array().cast("array<string>"))


def restrict_dimensions(df, dims):
    """Keep only the given dimensions' scores; the rest become unscored."""
    return df.withColumns(
        {c: F.lit(None).cast("double") for d, c in zip(DIMENSIONS, DIM_COLUMNS) if d not in dims and c in df.columns}
    )
