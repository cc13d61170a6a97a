"""Every example job against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as entry
from guardlake.plans import oracle, queries, streams
from tests.compare import compare, connect

QUERIES, SQL = {**queries.queries(), **streams.queries()}, oracle.SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_job_is_registered_once():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize(
    "name",
    ["agent_mode", "agent_accepted_prefix", "agent_risk_summary", "agent_patterns", "guardrail_pairs", "plan_verdict"],
)
def test_same_as_sql_with_split_keys(spark, sf_dir, con, name):
    spark.conf.set("spark.guardlake.rowsPerChunk", "8")
    try:
        assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None
    finally:
        spark.conf.unset("spark.guardlake.rowsPerChunk")


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and "risk_trend" in out.columns
