"""Every registered query with SQL gives what DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import canonical
from conftest import TESTDATA

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, TESTDATA).toPandas()
    assert canonical(got) == canonical(db.sql(ORACLES[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == 3
