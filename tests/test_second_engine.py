"""Every query with SQL against the second engine, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, engine, name):
    got = entry.queries()[name](spark, SF)
    names = sorted(got.columns)
    result = engine.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    wanted = sorted(repr(tuple(row[columns.index(c)] for c in names)) for row in result.fetchall())
    assert sorted(repr(tuple(r[c] for c in names)) for r in got.collect()) == wanted
