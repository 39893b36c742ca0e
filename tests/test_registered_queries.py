"""Every registered query with expected SQL, compared with another engine on the smallest tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SLOW = {"publish_roundtrip"}  # covered by test_run


@pytest.fixture(scope="module")
def other_engine(small):
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(small, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - SLOW))
def test_same_rows(spark, small, other_engine, name):
    df = queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted([tuple(normal(r[c]) for c in columns) for r in df.collect()], key=repr)
    expected = other_engine.sql(oracle_sql()[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    assert got == sorted([tuple(normal(r[i]) for i in order) for r in expected.fetchall()], key=repr)


def test_every_key_is_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark, small):
    assert entry(spark).count() > 0
