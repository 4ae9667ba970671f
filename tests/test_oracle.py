"""Every registered query against DuckDB on the same files."""

import pytest
from conftest import SF
from oracle import compare, connect

from tidemark.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_sql_only_for_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
