"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
import compare
from reddwatch.checks.oracle import ORACLE
from reddwatch.checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.oracle_connection(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert compare.difference(spark, connection, SF, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
