"""Every registered query with a SQL twin against DuckDB, over the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    ok, _, _, note = compare(spark, con, name, SF)
    assert ok, note
