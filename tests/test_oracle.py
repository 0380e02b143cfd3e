"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from catalogue.compare import connect, difference
from catalogue.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
