"""Pages of a large registry that are sought, not counted off.

The registry is written in ranges of the page order.  A page begins at a known row
of a known range: the rows that a filter leaves in each range are counted, sums of
these counts say which ranges hold the page, and only those are read and ordered.
"""

from pyspark.sql import functions as F

from guardlake.operators.registry import matching_tools

PART = "page_part"
ORDER = ["tool_name", "source"]


def write_pages(registry, path, *, partitions=None):
    """Write a registry to ``path`` in ranges of tool name and source, each in its own folder."""
    n = partitions or int(registry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = registry.repartitionByRange(n, *ORDER).withColumn(PART, F.spark_partition_id())
    ranged.write.partitionBy(PART).parquet(path)


def seek_page(spark, path, *, limit=50, offset=0, source=None, risk_level=None, search=None):
    """The page that :func:`~guardlake.operators.registry.list_tools` gives, from a table of :func:`write_pages`.

    One job counts the matching rows of each range, reading what the filter needs;
    the page then reads the ranges that hold it, one or two as a rule.  Offsets cost
    nothing but sums over as many numbers as there are ranges.
    """
    found = matching_tools(spark.read.parquet(path), source=source, risk_level=risk_level, search=search)
    base, holding, skipped = 0, [], 0
    for part, n in found.groupBy(PART).agg(F.count(F.lit(1))).orderBy(PART).collect():
        if base + n <= offset:
            skipped = base + n
        elif base < offset + limit:
            holding.append(part)
        base += n
    page = found.where(F.col(PART).isin(holding)).drop(PART).orderBy(*ORDER).offset(offset - skipped).limit(limit)
    return page.withColumns({"total": F.lit(base).cast("long"), "has_more": F.lit(base > offset + limit)})
