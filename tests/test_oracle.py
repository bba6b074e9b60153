import os

import pytest

import __spark_entry__ as contract
from tests.compare import assert_equal, duck
from tidedesk_checks.oracle import ORACLE
from tidedesk_checks.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, connection, key):
    assert_equal(contract.queries()[key](spark, SF_DIR), connection, contract.oracle_sql()[key])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 5
