"""Every operator query that SQL can express against its SQL on whole tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import compare  # noqa: E402
from scopewise.llm.queries import RUN, SQL  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    database = compare.connect(SF_DIR)
    found = RUN[name](spark, SF_DIR)
    assert compare.spark_types(found) == compare.duckdb_types(database, SQL[name])
    rows = compare.spark_rows(found)
    assert rows and rows == compare.duckdb_rows(database, SQL[name])
