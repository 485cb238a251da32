"""Every query against its SQL twin on DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from dockline.plans.catalog import QUERIES
from dockline.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def sorted_rows(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    expected = duck.sql(contract.oracle_sql()[name])
    types = {c: DUCK_TYPES[t] for c, t in df.dtypes}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    assert sorted_rows(df.collect(), df.columns) == sorted_rows(expected.fetchall(), expected.columns)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"arrondissement", "sum_bikes", "sum_mechanical", "sum_ebike"}


def test_table_order(spark):
    rows = contract.queries()["stations_table"](spark, SF_DIR).collect()
    keys = [(r.arrondissement, r.stationcode) for r in rows]
    assert keys == sorted(keys)
