"""Operators that SQL can express, against that SQL over the driver's tables."""

import os

import duckdb
import pytest

from tests.compare import assert_equal
from tidedesk.llm.queries import LLM_ORACLE, LLM_QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, key):
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    assert_equal(LLM_QUERIES[key](spark, SF_DIR), connection, LLM_ORACLE[key])
