"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, con, name):
    same, note = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert same, note


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_has_rows(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
