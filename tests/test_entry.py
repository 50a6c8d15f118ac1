"""Every query that has SQL against it on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, tables, name):
    df = queries()[name](spark, FOLDER)
    result = tables.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert by_name(df.collect(), df.columns) == by_name(result.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() > 0
