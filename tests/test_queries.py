"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from claimflow.binding import catalog
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []
