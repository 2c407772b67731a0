"""Replacing a table as a whole, so that readers see the old rows or the new ones."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from shoplake.sinks.catalog import FILE_FORMATS, register_external
from shoplake.sinks.files import overwrite

SNAPSHOT = "snapshot-"
#: Snapshots that stay: the newest one, and the one before it for readers that have begun.
KEPT = 2


def replace_table(
    df: DataFrame, table: str, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Write ``df`` as a new snapshot below ``path``, then have ``table`` show it, and return the table.

    ``df`` may read the table itself. A reader that has begun finishes on the snapshot that it saw, unless two more
    replacements come meanwhile. If writing fails, the table stays as it is, and the next
    replacement removes what was left behind. One writer at a time: of two, the last one wins.
    """
    spark = df.sparkSession
    if fmt not in FILE_FORMATS:  # table formats replace rows in one step by themselves
        overwrite(df, path, fmt)
        return register_external(spark, table, path, fmt, df.schema)
    version = f"{path}/{SNAPSHOT}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).options(**options).save(version)
    shown = register_external(spark, table, version, fmt, df.schema)
    _forget_old(spark, path, version)
    return shown


def _forget_old(spark: SparkSession, path: str, newest: str) -> None:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(to_path(path)))
    older = [n for n in names if n.startswith(SNAPSHOT) and n <= newest.rsplit("/", 1)[-1]]
    whole = [n for n in older if fs.exists(to_path(f"{path}/{n}/_SUCCESS"))]
    for name in set(older) - {*(whole or older)[-KEPT:], newest.rsplit("/", 1)[-1]}:
        fs.delete(to_path(f"{path}/{name}"), True)
