"""Every registered query against its SQL at the smallest scale."""

import os

import compare
import pytest

from scopewise.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, database, name):
    query = QUERIES[name]
    result = query.run(spark, SF_DIR)
    assert compare.spark_types(result) == compare.duckdb_types(database, query.sql)
    rows = compare.spark_rows(result)
    expected = compare.duckdb_rows(database, query.sql)
    assert rows == expected
    assert rows


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_gives_rows(spark, name):
    assert QUERIES[name].run(spark, SF_DIR).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
