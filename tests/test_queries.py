"""Each registered query against the same query in SQL on DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.batch import BATCH_QUERIES
from workload.oracle import ORACLE
from workload.streams import STREAM_QUERIES

QUERIES = {*BATCH_QUERIES, *STREAM_QUERIES}

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def comparable(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in found), key=repr)


def test_every_query_has_sql():
    assert QUERIES == set(ORACLE)
    assert QUERIES <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert len(entry_points.entry(spark).collect()) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, DATA)
    want = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert comparable(got.columns, got.collect()) == comparable(names, want.fetchall())
