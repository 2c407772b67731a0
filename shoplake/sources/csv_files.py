"""CSV files of the raw zone."""

from __future__ import annotations

from functools import reduce
from operator import add
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.sources.files import list_files

# How times are written: microseconds are kept.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CSV_SUFFIX = ".csv"


def scan_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, str] | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Scan headed CSV. Columns named in ``types`` get that type, others are inferred.

    Inference is a pass over all the data, so it runs only when some column needs it.
    Without ``types`` every column is inferred, with Spark's default options. Times may have a
    "T" or a blank before the hour, fewer parts than seconds, or no hour at all. A value that
    has no room in its type is NULL here; ``lost_values`` has its text. With ``multi_line``
    a file is not split: each is read by one task.
    """
    if not types:
        reader = spark.read.options(header=True, multiLine=multi_line, **options)
        return reader.options(inferSchema=True).csv(path)
    texts = scan_texts(spark, path, types, multi_line, **options)
    return texts.select(*typed(texts, types))


def scan_texts(
    spark: SparkSession, path: str, types: dict[str, str], multi_line: bool = False, **options: str
) -> DataFrame:
    """As ``scan_csv``, but columns named in ``types`` are still text."""
    reader = spark.read.options(header=True, multiLine=multi_line, **options)
    names = reader.csv(path).columns
    kinds: dict[str, T.DataType] = {name: T.StringType() for name in names}
    if not all(name in types for name in names):
        inferred = reader.options(inferSchema=True).csv(path).schema
        kinds |= {f.name: f.dataType for f in inferred if f.name not in types}
    schema = T.StructType([T.StructField(name, kinds[name]) for name in names])
    reader = spark.read.options(header=True, multiLine=multi_line, **options)
    return reader.options(timestampNTZFormat=TIME_FORMAT, enforceSchema=False).schema(schema).csv(path)


def typed(texts: DataFrame, types: dict[str, str]) -> list[Column]:
    return [
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in texts.columns
    ]


def is_lost(name: str, kind: str) -> Column:
    """True for a text that its type cannot hold, or holds only rounded."""
    text = F.col(f"`{name}`")
    value = text.try_cast(kind)
    lost = text.isNotNull() & value.isNull()
    if kind.startswith("decimal"):
        exact = text.try_cast("decimal(38,18)")
        lost = lost | F.coalesce(exact != value, F.lit(False))
    return lost


def count_lost(texts: DataFrame, types: dict[str, str]) -> Column:
    """Aggregate: how many values of all typed columns are lost."""
    flags = [is_lost(c, types[c]).cast("int") for c in texts.columns if c in types]
    return F.coalesce(F.sum(reduce(add, flags, F.lit(0))), F.lit(0)).alias("lost")


def lost_values(texts: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column_name, value, line): each lost text, with its whole row as JSON."""
    found = [
        F.when(is_lost(c, types[c]), F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")))
        for c in texts.columns
        if c in types
    ]
    if not found:
        nothing = F.lit("")
        return texts.limit(0).select(
            nothing.alias("column_name"), nothing.alias("value"), nothing.alias("line")
        )
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in texts.columns]))
    losses = F.explode(F.array_compact(F.array(*found))).alias("lost")
    return texts.select(losses, row.alias("line")).select("lost.*", "line")


def discover_csv(spark: SparkSession, raw_folder: str) -> DataFrame:
    """Entries of the raw folder ending in ".csv", as (file_name, table_name).

    An entry is a file, or a folder of part files as a distributed writer leaves it.
    """
    inside = F.substring_index("path", urlparse(raw_folder).path.rstrip("/") + "/", -1)
    return (
        list_files(spark, raw_folder)
        .select(F.substring_index(inside, "/", 1).alias("file_name"))
        .where(F.endswith("file_name", F.lit(CSV_SUFFIX)))
        .distinct()
        .withColumn("table_name", F.replace("file_name", F.lit(CSV_SUFFIX), F.lit("")))
    )
