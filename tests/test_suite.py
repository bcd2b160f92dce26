"""Every registered query against DuckDB over the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from rowloom.suite import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def test_contract(spark):
    assert set(SQL) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, SF)
    want = duck.sql(contract.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in found.collect()), key=repr)
    place = [want.columns.index(c) for c in columns]
    assert got == sorted(([plain(r[i]) for i in place] for r in want.fetchall()), key=repr)
    assert got
