"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import oracle
from boxledger.showcase import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    query = QUERIES[name]
    assert query.oracle() is not None, "every query has an SQL form"
    assert oracle.differences(query.run(spark, SF_DIR), duck, query.oracle()) is None


def test_entry_points():
    import __spark_entry__ as entry
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
