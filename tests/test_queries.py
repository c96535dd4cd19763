"""Every named query against its SQL on the smallest test data."""

from __future__ import annotations

import os

import pytest

from compare import compare, connect
from kalends.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
