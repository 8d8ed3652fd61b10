"""Every query with an SQL twin gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as entry
from oracle import assert_same

SQL = entry.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_duckdb(spark, folder, name):
    assert_same(entry.queries()[name](spark, folder), SQL[name], folder)


def test_every_query_outside_llm_has_sql():
    from precinct.plans.catalog import QUERIES

    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert entry.entry(spark).columns == ["state", "TIPO_DIA", "Suma_Total_Delitos"]
