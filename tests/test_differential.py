"""Every registered query against its SQL."""

from __future__ import annotations

import __spark_entry__ as entry_points
import pytest

from lodeworks.queries import ORACLE, QUERIES

from tests.differential import difference, open_tables

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, tables, ORACLE[name]) is None


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
