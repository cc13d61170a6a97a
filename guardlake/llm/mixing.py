"""Mixing sources to target weights."""

import itertools
import math

from pyspark.sql import functions as F

#: Hex digits of the hash that make up the uniform number: 52 bits, exact in a double.
DIGITS = 13
#: Largest mean of :func:`poisson_steps`, whose first term must not vanish; beyond it :func:`poisson_window` stands in.
LARGE = 500
#: Copies of one document that are written out in one place when its source's rate is over LARGE.
BLOCK = 4096


def poisson_steps(mean):
    """Cumulative probabilities P(count <= 0), P(count <= 1), ... up to the last that a 52-bit number can miss."""
    if mean <= 0:
        return [1.0]
    if mean > LARGE:
        raise ValueError(f"the first probability of a mean over {LARGE} is too small to start from; use poisson_window")
    steps, term, total, k = [], math.exp(-mean), 0.0, 0
    while True:
        total += term
        steps.append(total)
        if k > mean and term < 2.0**-60:
            return steps
        k += 1
        term *= mean / k


def poisson_window(mean):
    """(first, steps) for any mean: P(count <= first), P(count <= first + 1), ... as far as a 52-bit number can tell them.

    Terms are taken relative to the largest one and divided by their sum, so
    nothing vanishes; counts outside have less than 2^-70 of the largest probability.
    """
    if mean <= LARGE:
        return 0, poisson_steps(mean)
    top, least = int(mean), 2.0**-70
    below, term, k = [], 1.0, top
    while k > 0 and term > least:
        term *= k / mean
        k -= 1
        below.append(term)
    above, term, k = [], 1.0, top
    while term > least:
        k += 1
        term *= mean / k
        above.append(term)
    terms = [*below[::-1], 1.0, *above]
    total = math.fsum(terms)
    return top - len(below), [x / total for x in itertools.accumulate(terms)]


def _count(drawn, mean):
    """Inverse of the Poisson distribution of that mean at the number."""
    first, steps = poisson_window(mean)
    # One literal, not one per step: a mean of a million has tens of thousands.
    steps = F.split(F.lit(",".join(map(repr, steps))), ",").cast("array<double>")
    return F.lit(first) + F.size(F.filter(steps, lambda x: x <= drawn))


def uniform(*parts):
    """Number in [0, 1) from a hash of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(16.0**DIGITS)


def repetition_rates(docs, weights, source="source"):
    """Mean number of copies of a document of each weighted source.

    The weighted sources together keep their number of rows; within it each gets
    its weight's share.  Only the weighted sources, as many as the caller lists, come to
    the driver.
    """
    counted = (
        docs.where(F.col(f"`{source}`").isin(list(weights)))
        .groupBy(F.col(f"`{source}`").alias("source"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    rows = {r["source"]: r["n"] for r in counted}
    total, weight = sum(rows.values()), sum(weights[s] for s in rows)
    return {s: weights[s] / weight * total / n if weight else 0.0 for s, n in rows.items()}


def mix_sources(docs, weights, seed=42, doc_id="doc_id", source="source", partitions=None):
    """Repeat each document a Poisson number of times and shuffle all copies globally.

    ``weights`` maps a source to its target share.  The count is the inverse of
    the Poisson distribution, with the source's repetition rate as its mean, at a
    number hashed from seed and id, so reruns and retried tasks give the same
    copies.  Returns the columns of ``docs`` in ``row``, ``copy`` (from 1) and
    ``place``, the number hashed from seed, id and copy that orders the result.

    Defined cases: a source without weight, null included, keeps each row once; a
    null id hashes like an empty string; rows with the same id get the same count;
    an empty table gives no rows; a weight of 0 removes the source, as asked.  A
    source may be as rare as it likes: where its rate is over ``LARGE`` its documents'
    copies are dealt out in blocks before they are written out.
    """
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rates = repetition_rates(docs, weights, source)
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = F.coalesce(F.col("row").getField(doc_id).cast("string"), F.lit(""))
    drawn = uniform(F.lit(str(seed)), key)
    origin = F.col("row").getField(source)

    def repeated(rows, rates):
        by_source = F.lit(1)
        for name, rate in sorted(rates.items()):
            by_source = F.when(origin == name, _count(drawn, rate)).otherwise(by_source)
        return rows.withColumn("copies", by_source).where("copies > 0")

    many = {name: rate for name, rate in rates.items() if rate > LARGE}
    rare = F.coalesce(origin.isin(list(many)), F.lit(False))
    usual = repeated(base.where(~rare) if many else base, {name: rate for name, rate in rates.items() if name not in many})
    each = usual.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    if many:
        parts = repeated(base.where(rare), many)
        parts = parts.select("row", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"), F.lit(BLOCK))).alias("start"))
        parts = parts.repartition(partitions, key, "start")
        upto = F.least(F.col("start") + F.lit(BLOCK - 1), F.col("copies"))
        each = each.unionByName(parts.select("row", F.explode(F.sequence(F.col("start"), upto)).alias("copy")))
    placed = each.withColumn("place", uniform(F.lit(f"{seed}-place"), key, F.col("copy").cast("string")))
    return placed.repartitionByRange(partitions, "place").sortWithinPartitions("place", "copy")


def mixed_documents(docs, weights, seed=42, doc_id="doc_id", source="source"):
    """The copies that :func:`mix_sources` makes, with the columns of ``docs``."""
    return mix_sources(docs, weights, seed, doc_id, source).select("row.*")
