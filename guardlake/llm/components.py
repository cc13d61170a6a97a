"""Connected components of a table of edges."""

from guardlake.llm.tables import written
from pyspark.sql import functions as F


def components(edges, folder):
    """(node, label) for every node of ``edges`` (columns a, b); the label is the component's smallest node.

    Large-star and small-star steps alternate until the edges are stars around
    the smallest nodes, which takes a number of rounds logarithmic in the nodes.
    Minima are partial aggregates joined back, so a node with very many edges is
    no group of its own task.  Each round is written to ``folder``, a new folder
    that all executors share.  Edges from a node to itself are left out.
    """

    def saved(frame, name):
        return written(frame, f"{folder}/{name}")

    def digest(frame):
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "round-0"
    )
    before, k = None, 0
    while (after := digest(now)) != before:
        before, k = after, k + 1
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, f"large-{k}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(low.withColumnRenamed("m", "v").union(rest).distinct(), f"round-{k}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
