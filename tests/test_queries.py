"""Every query with an SQL twin, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
TWINS = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_twin(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    res = duck.execute(TWINS[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, res.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
