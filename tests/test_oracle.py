"""Every registered query against its SQL, on the smallest given data."""

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

FOLDER = entry.SMOKE_DIR
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given data not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_sql_names_are_registered():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_yields_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_a_stable_schema(spark):
    assert entry.entry(spark).columns == ["year", "month", "revenue", "order_count"]
