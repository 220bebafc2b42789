"""Every registered query against DuckDB on the same parquet tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["lineitem", "orders", "part", "documents", "embeddings", "pages", "conversations"]

@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    ours = entry.queries()[name](spark, SF_DIR)
    theirs = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in theirs.description]
    expected = theirs.fetchall()
    described = duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()
    assert {c: KINDS[kind] for c, kind in ours.dtypes} == {row[0]: row[1] for row in described}
    found = [tuple(row) for row in ours.collect()]
    assert sorted(ours.columns) == sorted(columns)
    assert found and len(found) == len(expected)
    assert _rows(ours.columns, found) == _rows(columns, expected)


def test_no_query_of_the_retail_part_lacks_sql():
    own = {name for name in entry.queries() if not name.startswith("op") and name != "pipeline"}
    assert own <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_the_labelled_feature_table(spark):
    frame = entry.entry(spark)
    assert frame.columns[-1] == "stock_decision"
    assert frame.count() == 3130
