"""Exact dedup by content sort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: One row in so many is looked at to find texts that fill more than a task.
SAMPLE_EVERY = 64
#: Length of the text's head in the range key; longer heads only make the splitters larger.
HEAD = 32


def normalised(text):
    """Text with A-Z lower-cased; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def _hot_hashes(docs, hash_column, partitions):
    """Hashes of texts so frequent that one task should not get all their copies.

    Only decides how rows are dealt out, never what comes out.  A text is listed
    if it holds over a quarter of a partition's share of the sample, so the list
    has at most four entries per partition.
    """
    sample = docs.sample(fraction=1.0 / SAMPLE_EVERY, seed=17).groupBy(hash_column.alias("h")).count()
    total = sample.agg(F.sum("count").alias("rows"))
    hot = sample.join(F.broadcast(total)).where(
        (F.col("count") >= 4) & (F.col("count") * 4 * partitions > F.col("rows"))
    )
    return [r["h"] for r in hot.select("h").collect()]


def mark_copies(docs, doc_id="doc_id", text="text", keep="smallest", partitions=None):
    """One row per input row: ``row`` (the input row), ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are after lower-casing A-Z.  Sampled
    splitters range-partition the rows by the head and a hash of the normalised
    text, an external sort puts equal texts side by side, and the window compares
    neighbours over the whole text.  Frequent texts are dealt out in several
    pieces; the size and kept id of their whole groups come from an aggregate
    that each map task starts by itself.

    Defined cases: a null text equals an empty one; a null id is never the kept
    one while the group has another; of rows with the same id and text one is
    kept; the empty table gives no rows; columns of any name may be in ``docs``.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base = base.select(
        F.col("row").getField(doc_id).alias("id"), normalised(F.col("row").getField(text)).alias("norm"), "row"
    )
    slim = docs.select(normalised(F.col(f"`{text}`")).alias("norm"))
    hot = _hot_hashes(slim, F.xxhash64("norm"), partitions)
    hashed = base.withColumn("hash", F.xxhash64("norm")).withColumn("head", F.substring("norm", 1, HEAD))
    dealt = hashed.withColumn("hot", F.col("hash").isin(hot)).withColumn(
        "piece", F.pmod(F.xxhash64("id"), F.when(F.col("hot"), F.lit(partitions)).otherwise(F.lit(1)))
    )
    ranged = dealt.repartitionByRange(partitions, "head", "hash", "piece")
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    run = Window.partitionBy("head", "hash", "piece", "norm").orderBy(order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = ranged.select(
        "row",
        "id",
        "norm",
        "hot",
        F.row_number().over(run).alias("place"),
        F.first("id").over(whole).alias("run_id"),
        F.count(F.lit(1)).over(whole).alias("run_size"),
    ).withColumn("sha", F.sha2("norm", 256))
    # Whole groups of the frequent texts, a row per text and map task before the shuffle.
    best = F.min("id") if keep == "smallest" else F.max("id")
    merged = (
        dealt.where("hot")
        .groupBy("norm")
        .agg(best.alias("all_id"), F.count(F.lit(1)).alias("all_size"))
        .select(F.sha2("norm", 256).alias("hot_sha"), "all_id", "all_size")
    )
    # At most four hot texts per partition, a digest and two numbers each.
    joined = runs.drop("norm").join(F.broadcast(merged), F.col("hot") & (F.col("sha") == F.col("hot_sha")), "left")
    keep_id = F.when(F.col("hot"), F.col("all_id")).otherwise(F.col("run_id"))
    return joined.select(
        "row",
        F.col("id"),
        keep_id.alias("keep_id"),
        F.when(F.col("hot"), F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs, doc_id="doc_id", text="text", keep="smallest"):
    """The rows of ``docs`` that :func:`mark_copies` keeps, with their columns."""
    return mark_copies(docs, doc_id, text, keep).where("kept").select("row.*")
