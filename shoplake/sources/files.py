"""What files lie in a folder, from a listing alone: no file content is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A listing reads no content, so its tasks need not grow with the data.
LISTING_TASKS = 64


def list_files(spark: SparkSession, *folders: str, glob: str | None = None) -> DataFrame:
    """One row per file below the folders: path, name, size in bytes.

    The number of tasks is bounded: without that each large file would be a task of its own.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(list(folders)).coalesce(LISTING_TASKS).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
    )


def landing_summary(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """One row: how many files, how many bytes."""
    return list_files(spark, folder, glob=glob).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes")
    )


def landing_head(spark: SparkSession, folder: str, n: int = 5, glob: str | None = None) -> DataFrame:
    """Name and size of ``n`` of the files."""
    return list_files(spark, folder, glob=glob).select("name", "size").limit(n)


def total_bytes(spark: SparkSession, *folders: str) -> int:
    """Bytes of all files below the folders, from the planner's listing: no job runs."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
    return int(str(listed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def make_folder(spark: SparkSession, folder: str) -> None:
    """Create the folder where it does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
