"""Every registered query against its SQL in another engine."""

import pytest

import __spark_entry__ as contract
from intentmill.plans.oracle import ORACLE_SQL
from intentmill.plans.queries import QUERIES
from oracle_check import connect, differences

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    assert differences(df, con, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 6
