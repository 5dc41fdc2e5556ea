"""Every registered query against its SQL, value by value."""

from __future__ import annotations

import compare
import pytest

from keelstone import catalog

QUERIES, SQL = catalog.all_queries(), catalog.all_sql()

# The scale of the driver's comparison; tools/compare.py runs the others.
SCALE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SCALE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    error, _ = compare.compare(spark, duck, name, QUERIES[name], SQL.get(name), SCALE)
    assert error is None, error


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())
