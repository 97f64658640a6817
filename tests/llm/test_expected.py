"""Queries of the operators against their expected results in SQL, over the whole smallest tables."""

import pytest

from conformance.check import compare, connect
from tradewind.llm.queries import EXPECTED, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(EXPECTED))
def test_query(spark, name):
    ok, note = compare(QUERIES[name](spark, SF), connect(SF), EXPECTED[name])
    assert ok, note


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
