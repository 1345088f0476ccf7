"""Every registered query against its oracle SQL, on the smallest data."""

import os

import pytest

import __spark_entry__ as contract
from oracle import compare, connect
from tidefold.plans import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    same, n, expected, diff = compare(
        spark, con, contract.queries()[name], contract.oracle_sql()[name], SF
    )
    assert same, f"{n} rows, expected {expected}: {diff}"


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
