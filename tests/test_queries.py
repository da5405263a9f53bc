"""Every query against its SQL at the smallest scale factor."""

import functools

import pytest

import __spark_entry__ as contract
from catalog import air
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def star_tables_built_once():
    """The charts read the same star schema; building it for each of them would only repeat the gap filling."""
    build = air.star_tables
    air.star_tables = functools.cache(build)
    yield
    air.star_tables = build


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    problem = compare(got, duck.execute(contract.oracle_sql()[name]).df())
    assert not problem or problem.startswith("note"), problem


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
