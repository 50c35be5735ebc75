"""Each numbered query against its DuckDB SQL, on the smallest tables."""

import pytest

import __spark_entry__ as E
from duck_compare import compare, duck_connection
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck_connection(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_all_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
