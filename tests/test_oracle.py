"""Every plan with SQL gives the rows that an independent engine gives."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tabulyte.plans.registry import TABLE_NAMES
from tools.compare import compare

QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.mark.parametrize("key", sorted(SQL))
def test_same_rows_as_sql(spark, sf, key):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    state, _, note = compare(spark, con, key, QUERIES[key], SQL[key], sf)
    assert state in ("OK", "EMPTY"), note


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 1
