"""Exact top-k search by inner product."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

#: Queries and candidates that one task scores against each other.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
#: Entries of a dense score array; candidates are scored in slices of so many.
SCORES = 1 << 21


def _flat(column):
    """Offsets and values of a list column, whatever slice it is."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), np.asarray(column.flatten(), np.int64)


def _postings(offsets, weights):
    """Entries of term t are rows[at[t]:at[t + 1]] with their weights; zeros are left out."""
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(weights)) - np.repeat(offsets[:-1], lengths)
    used = weights != 0
    order = np.argsort(terms[used], kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(terms[used], minlength=1))])
    return at, rows[used][order], weights[used][order]


def best_of_block(query_rows, q_offsets, q_weights, ids, own_rows, offsets, weights, k):
    """The k best candidates of a block for each query but its own row: place of the query, candidate id, score."""
    order = np.argsort(ids, kind="stable")
    found = [[], [], []]
    at, rows, values = _postings(offsets, weights)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))  # scores are kept in the order of ids, so ties fall to the smaller
    rows, ids, own_rows = rank[rows], ids[order], own_rows[order]
    by_row = np.argsort(own_rows, kind="stable")
    step = max(1, SCORES // max(1, len(ids)))
    for first in range(0, len(query_rows), step):
        some = range(first, min(first + step, len(query_rows)))
        scores = np.zeros((len(some), len(ids)), np.int64)
        for i, q in enumerate(some):
            for term, weight in enumerate(q_weights[q_offsets[q] : q_offsets[q + 1]]):
                if weight and term + 1 < len(at):
                    entries = slice(at[term], at[term + 1])
                    scores[i, rows[entries]] += weight * values[entries]  # a candidate occurs once per term
        for i, q in enumerate(some):
            own = np.searchsorted(own_rows, query_rows[q], sorter=by_row)
            line, others = scores[i], np.arange(len(ids))
            if own < len(ids) and own_rows[by_row[own]] == query_rows[q]:
                others = np.delete(others, by_row[own])
            if len(others) > k:
                part = line[others]
                kth = -np.partition(-part, k - 1)[k - 1]
                above = others[part > kth]
                others = np.concatenate([above, others[part == kth][: k - len(above)]])
            found[0].append(np.full(len(others), q))
            found[1].append(ids[others])
            found[2].append(line[others])
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]


def integer_vectors(table, vec_id="vec_id", vector="embedding", scale=1024):
    """(id, row, vector) with components floor(scale * x); ``row`` numbers the rows of the table.

    Vectors that are null or hold a null or non-finite component, and rows with a
    null id, are left out.  Rows with the same id are vectors of their own.  The
    numbers follow the table's files, so a task that is run again gives the same.
    """
    x = F.col(f"`{vector}`")
    # NaN sorts above infinity, so it fails the comparison as well.
    fits = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < F.lit(math.inf)))
    whole = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    kept = F.when(F.coalesce(fits, F.lit(False)), whole)
    rows = table.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), kept.alias("vector"))
    return rows.where("id is not null and vector is not null")


def top_k(candidates, queries, k=10):
    """The k candidates of highest inner product for each query, ties to the smaller id.

    Both frames have ``id``, ``row`` and integer ``vector``, from one table of
    :func:`integer_vectors`; a query's own row is not its neighbour, other rows with
    its id are, and queries with equal ids are answered each for itself.  Queries
    and candidates are dealt into blocks of bounded size by a hash of the row; each
    task takes one block of either, adds up weight times posting term by term into
    dense score arrays, selects by partition, and the block results, k rows a
    query, are merged by rank.  Vectors of unlike length are padded with zeros.
    Scores are 64-bit integers; an inner product has to fit.
    Returns query_id, rank, vec_id, score.
    """
    n_queries = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    n_candidates = max(1, math.ceil(candidates.count() / CANDIDATE_BLOCK))

    def dealt(frame, own, other, names):
        block = F.pmod(F.xxhash64("row"), F.lit(own)).cast("int").alias(names[0])
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1])
        return frame.select("id", "row", "vector", block, every)

    left = dealt(queries, n_queries, n_candidates, ("q", "c"))
    right = dealt(candidates, n_candidates, n_queries, ("c", "q"))

    names = ("query_row", "query_id", "vec_id", "score")

    def score(some, block):
        if not some.num_rows or not block.num_rows:  # a block that no row fell into
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        q_offsets, q_weights = _flat(some["vector"])
        offsets, weights = _flat(block["vector"])
        place, ids, scores = best_of_block(
            np.asarray(some["row"]), q_offsets, q_weights, np.asarray(block["id"]), np.asarray(block["row"]), offsets, weights, k
        )
        query = pa.array(place, pa.int64())
        columns = [some["row"].take(query), some["id"].take(query), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())]
        return pa.table(dict(zip(names, columns)))

    scored = (
        left.groupBy("q", "c")
        .cogroup(right.groupBy("q", "c"))
        .applyInArrow(score, "query_row long, query_id long, vec_id long, score long")
    )
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
