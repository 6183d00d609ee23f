"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import compare
import pytest

ENTRY = compare.load_entry()


@pytest.fixture(scope="module")
def con(sf):
    return compare.duck(sf)


@pytest.mark.parametrize("name", list(ENTRY.REGISTRY))
def test_query_agrees_with_sql(spark, con, sf, name):
    assert compare.run(spark, con, ENTRY, name, sf) is None


def test_registry_is_complete():
    assert set(ENTRY.REGISTRY) <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


def test_entry(spark):
    assert ENTRY.entry(spark).count() == 72
