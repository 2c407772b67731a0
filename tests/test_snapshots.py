"""Tables are replaced as a whole, and entries change in place."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shoplake.sinks.catalog import create_database, register_external
from shoplake.sinks.files import overwrite
from shoplake.sinks.snapshots import replace_table


@pytest.fixture
def place(spark, cfg):
    create_database(spark, cfg.database, cfg.database_folder())
    return cfg.table("t"), cfg.processed("t")


def test_a_reader_that_has_begun_finishes(spark, place):
    name, path = place
    replace_table(spark.range(5), name, path)
    reader = spark.table(name).where("id >= 0")
    parts = reader.toLocalIterator()
    first = next(parts)
    replace_table(spark.range(5, 8), name, path)
    assert sorted([first[0], *[r[0] for r in parts]]) == [0, 1, 2, 3, 4]
    assert rows(spark.table(name)) == [(5,), (6,), (7,)]
    for k in range(4):
        replace_table(spark.range(k), name, path)
    assert len(list(Path(path).glob("snapshot-*"))) == 2


def test_a_failed_rebuild_leaves_the_old_table(spark, place):
    name, path = place
    replace_table(spark.range(5), name, path)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, name, path)
    assert rows(spark.table(name)) == [(i,) for i in range(5)]
    replace_table(spark.range(1), name, path)
    replace_table(spark.range(2), name, path)
    assert rows(spark.table(name)) == [(0,), (1,)]
    assert len(list(Path(path).glob("snapshot-*"))) == 2  # what the failure left is gone


def test_a_table_may_be_made_from_itself(spark, place):
    name, path = place
    replace_table(spark.range(2), name, path)
    told = replace_table(spark.table(name).selectExpr("id + 1 AS id", "'x' AS more"), name, path)
    assert rows(told) == [(1, "x"), (2, "x")]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_table_is_found_while_it_is_registered_again(spark, cfg, fmt):
    """Another place, other columns, other types, fewer columns: looked up in a loop, it is always there."""
    create_database(spark, cfg.database, cfg.database_folder())
    name = cfg.table("t")
    shapes = [
        spark.range(3),
        spark.range(4),
        spark.range(2).selectExpr("'a' AS name", "id"),
        spark.range(2).selectExpr("CAST(id AS string) AS id"),
    ]
    for k, df in enumerate(shapes):
        overwrite(df, cfg.processed(f"place{k}"), fmt)
    register_external(spark, name, cfg.processed("place0"), fmt)
    missed, done = [], threading.Event()

    def look():
        while not done.is_set():
            missed.append(not spark.catalog.tableExists(name))

    looker = threading.Thread(target=look)
    looker.start()
    try:
        for _ in range(3):
            for k, df in enumerate(shapes):
                told = register_external(spark, name, cfg.processed(f"place{k}"), fmt)
                assert told.columns == df.columns and rows(told) == rows(df)
    finally:
        done.set()
        looker.join()
    assert len(missed) > 5 and not any(missed)
