"""Every registered query against its SQL text, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from wortfund.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_sql_text():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    found = sorted(map(tuple, found.select(*columns).collect()))
    cursor = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert found == expected
