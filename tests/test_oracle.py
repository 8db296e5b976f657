"""Every registered query against its SQL, on the smallest test tables (or those in TEST_SF_DIR)."""

import math
import os

import duckdb
import pytest

from txn_analytics.oracle import ORACLE
from txn_analytics.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def _value(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(([_value(row[at]) for at in order] for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = database.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert _sorted(result.columns, result.collect()) == _sorted(columns, cursor.fetchall())
