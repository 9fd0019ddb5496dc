"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import check, duck

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # queries of the optional subpackage without SQL are tested by brute force in its own tests
    assert set(entry._lake_sql()) == set(entry._lake_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = check(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert r["ok"], r
