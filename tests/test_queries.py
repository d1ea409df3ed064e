"""Registered queries against their check SQL on the smallest tables."""

import pytest

from catalog import QUERIES, checks
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
CHECKS = checks()
# tests/oracle.py runs them at any size
NAMES = sorted(CHECKS)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    _, _, ok, note = compare(spark, con, QUERIES[name], CHECKS[name], SF)
    assert ok, note


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
    assert QUERIES.keys() - CHECKS.keys() == {"stream_late_data_report"}
