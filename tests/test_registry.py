"""Every SQL-checked query against DuckDB, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert compare(frame, db, entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r.rows for r in rows) == 4027 and len(rows) == 5
