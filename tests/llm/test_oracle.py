"""The queries that SQL can express, and that everything else works without this subpackage."""

import subprocess
import sys

import __spark_entry__ as entry
import duckdb
import pytest
from guardlake.llm import oracle
from guardlake.llm import queries as llm

from tests.compare import compare, connect


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_same_as_sql(spark, sf_dir, name):
    with connect(sf_dir) as con:
        assert isinstance(con, duckdb.DuckDBPyConnection)
        assert compare(spark, con, sf_dir, llm.queries()[name], oracle.SQL[name]) is None


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_entry_works_without_the_subpackage():
    code = (
        "import sys; sys.modules['guardlake.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and len(e.queries()) > 90"
    )
    blocked = code.replace("sys.modules['guardlake.llm'] = None; sys.modules['corpus_pipeline'] = None", "pass")
    for text in (code, blocked.replace(" assert 'pipeline' not in", " assert 'pipeline' in")):
        subprocess.run([sys.executable, "-c", text], check=True)
