"""Every registered query against its SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from postlake.catalog.oracle import ORACLE
from postlake.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    made = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLE[name])
    columns = sorted(made.columns)
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in made.dtypes} == types
    order = [expected.columns.index(c) for c in columns]
    rows = sorted(repr(tuple(r[c] for c in columns)) for r in made.collect())
    assert rows == sorted(repr(tuple(r[i] for i in order)) for r in expected.fetchall())


def test_entry(spark):
    made = contract.entry(spark)
    assert made.count() > 0 and made.columns == contract.entry(spark).columns
