"""Every registered query with SQL gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from airmill.plans import catalog
from checks import oracles
from checks.compare import connect, differences

SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) == set(catalog.registered())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, folder, duck, name):
    assert differences(catalog.registered()[name](spark, folder).toPandas(), duck.sql(SQL[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 8
