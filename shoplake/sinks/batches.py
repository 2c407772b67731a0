"""Tables that grow by numbered batches, each of which appears whole and once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Options to read such a table with: every batch has a folder, and columns may have been added meanwhile.
READ_OPTIONS = {"recursiveFileLookup": "true", "mergeSchema": "true"}
#: The commit log of Spark's own file sink, which hides all files that it did not write.
FILE_SINK_LOG = "_spark_metadata"


def write_batch(rows: DataFrame, path: str, number: int, fmt: str = "parquet") -> bool:
    """Add ``rows`` as batch ``number`` of the table at ``path``; False if the table has it already.

    The rows are written to a hidden folder, which is renamed at the end: readers see a batch whole or not at
    all, and one that was cut off is written again. Where a rename is not atomic (most object stores), a
    reader may see part of a batch for a moment.
    """
    return _once(rows.sparkSession, path, number, lambda folder: rows.write.format(fmt).mode("overwrite").save(folder))


def _once(spark: SparkSession, path: str, number: int, write: Callable[[str], None]) -> bool:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    target = to_path(f"{path}/batch-{number:012d}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    hidden = f"{path}/_batch-{number:012d}"
    write(hidden)
    if not fs.rename(to_path(hidden), target):
        raise OSError(f"{hidden} could not be renamed to {target}")
    return True


def refuse_file_sink(spark: SparkSession, path: str) -> None:
    """Batches written beside the commit log of a file sink would not be seen."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FILE_SINK_LOG}")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} was written by Spark's file sink; move its files to a new folder without {FILE_SINK_LOG}")
