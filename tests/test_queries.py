"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, con, name):
    status, rows, _, _ = compare(spark, con, sf, entry.queries()[name], entry.oracle_sql().get(name))
    assert status in ("equal", "rows only", "EMPTY"), status


def test_entry(spark):
    assert entry.entry(spark).count() > 0
