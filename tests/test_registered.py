"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import oracle
import pytest

from deq.plans.registry import oracles, queries

FOLDER = "/root/testdata/sf0.001"
SQL = oracles()
# Three queries name things too rare for the smallest tables.
MAY_BE_EMPTY = {"tenant_filter", "entities_email_count"}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    run = queries()[name]
    found = [d for d in oracle.differences(spark, FOLDER, name, run, SQL[name], duck)]
    if name in MAY_BE_EMPTY:
        found = [d for d in found if d != "no rows"]
    assert not found


def test_every_query_has_its_sql():
    assert set(queries()) == set(SQL)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
