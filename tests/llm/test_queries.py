"""The registered corpus queries against DuckDB on the same files."""

import os

import pytest
from conftest import SF
from oracle import compare, connect

from tidemark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLES[name]) is None


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_entry_holds_them():
    import __spark_entry__ as e

    assert set(QUERIES) | {"pipeline"} <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nothing_outside_imports_the_subpackage():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(top, "tidemark")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "tidemark.llm" not in f.read()
