"""Every registered query with SQL gives the same rows as the SQL; the others give rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle_check import connect, differences

SF_DIR = "/root/testdata/sf0.01"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, contract.queries()[name], ORACLES[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).limit(1).count() == 1


def test_entry_gives_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
