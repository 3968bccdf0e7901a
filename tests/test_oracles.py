"""Every registered query against its SQL text on the given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from dayfold.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean", "DATE": "date", "DECIMAL(38,0)": "decimal(38,0)"}


def test_all_queries_have_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    expected_kinds = {c[0]: KINDS[str(c[1])] for c in cursor.description}
    assert dict(frame.dtypes) == expected_kinds
    expected = _sorted_rows(columns, cursor.fetchall())
    actual = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(actual) == len(expected) > 0
    assert actual == expected
