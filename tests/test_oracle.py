"""Every query against DuckDB on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted([tuple(_plain(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    df = queries()[name](spark, SF)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.columns, df.collect()) == _sorted(columns, expected)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
