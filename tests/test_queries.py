"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, difference


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'"
        )
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, small, name):
    got = entry.queries()[name](spark, small).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
    else:
        assert difference(got, duck.sql(sql).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
