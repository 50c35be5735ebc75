"""Every registered check against its DuckDB oracle, on the smallest tables."""

import pytest

import __spark_entry__ as E
from tidemark import checks
from duck_compare import compare, duck_connection

checks.load_all()
QUERIES = {name: fn for name, fn in E.queries().items() if name in checks.QUERIES}
ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in checks.QUERIES}


@pytest.fixture(scope="module")
def con(sf):
    return duck_connection(sf)


def test_every_check_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["user_id", "event_id"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert compare(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_non_empty(spark, sf, name):
    assert QUERIES[name](spark, sf).take(1)
