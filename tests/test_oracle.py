"""Every registered query against its SQL form, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.compare import TABLES, compare


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connection, name):
    status, rows, _, detail = compare(spark, connection, SMALL, name)
    assert status in ("ok", "rows"), detail


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
