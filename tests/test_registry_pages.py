"""Sought pages equal listed ones, and read the ranges that hold them."""

import os

import pytest
from pyspark.sql import functions as F

from guardlake.operators import registry, registry_pages


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    tools = spark.range(5000).select(
        F.concat(F.lit("tool_"), F.hash("id").cast("string"), F.col("id").cast("string")).alias("tool_name"),
        F.when(F.col("id") % 3 == 0, "org_custom").otherwise("system").alias("source"),
        F.when(F.col("id") % 4 == 0, "high").otherwise("low").alias("risk_level"),
    )
    path = str(tmp_path_factory.mktemp("pages") / "table")
    registry_pages.write_pages(tools, path, partitions=16)
    return tools, path


FILTERS = [{}, {"source": "org_custom"}, {"source": "all", "risk_level": "high", "search": "TOOL_-1"}, {"search": "no such"}]


@pytest.mark.parametrize("filters", FILTERS)
def test_same_as_listed(spark, table, filters):
    tools, path = table
    for limit, offset in ((50, 0), (7, 312), (400, 299), (50, 4990), (50, 5000), (0, 10)):
        got = registry_pages.seek_page(spark, path, limit=limit, offset=offset, **filters)
        want = registry.list_tools(tools, limit=limit, offset=offset, **filters)
        assert [tuple(r) for r in got.select(want.columns).collect()] == [tuple(r) for r in want.collect()]


def test_a_deep_page_reads_few_ranges(spark, table):
    _, path = table
    assert len([d for d in os.listdir(path) if d.startswith("page_part=")]) == 16
    page = registry_pages.seek_page(spark, path, limit=50, offset=4000)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert page.count() == 50 and 1 <= plan.split("page_part", 1)[1].count("PartitionFilters") <= 1
    files = {r.f.split("page_part=")[1].split("/")[0] for r in spark.read.parquet(path).where(F.col("tool_name").isin([r.tool_name for r in page.collect()])).select(F.input_file_name().alias("f")).collect()}
    assert len(files) <= 2
