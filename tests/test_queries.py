"""Every registered query against DuckDB on the same files."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF
from tieout.plans import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_each_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    relation = duck.sql(oracle.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    want = [tuple(r[i] for i in places) for r in relation.fetchall()]
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema:
        ours = field.dataType.simpleString()
        assert TYPES.get(ours, ours.upper()) == theirs[field.name], field.name


def test_entry(spark):
    assert {r.break_status: r.key_count for r in driver.entry(spark).collect()} == {
        "MATCHED": 1248, "AMOUNT_MISMATCH": 64, "TIMING_DIFFERENCE": 32,
        "MISSING_FROM_SUBLEDGER": 34, "MISSING_FROM_GL": 32, "DUPLICATE_IN_SUBLEDGER": 60,
    }
