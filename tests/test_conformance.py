"""Registered queries against their expected results on the smallest test folder."""

import pytest

from conformance import load_all
from conformance.check import compare, connect
from conformance.registry import EXPECTED, QUERIES

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(EXPECTED))
def test_query(spark, con, name):
    ok, note = compare(QUERIES[name](spark, SF), con, EXPECTED[name])
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
