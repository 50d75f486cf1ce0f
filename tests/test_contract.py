"""Every registered query against its DuckDB twin, and the driver's contract."""

import pytest

import __spark_entry__ as contract
from check import compare, connect
from quirebind.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches(spark, con, name):
    good, note = compare(spark, con, name, FOLDER)
    assert good, note


def test_contract(spark):
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
