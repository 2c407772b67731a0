"""Catalog database and external tables."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shoplake.config import quoted
from shoplake.sources.files import list_files

# Formats that keep no list of their partitions: the catalog has to find them.
FILE_FORMATS = ("parquet", "orc")


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{at}")


def register_external(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    partition_by: tuple[str, ...] = (),
    **options: str,
) -> DataFrame:
    """Make ``table`` an external table over ``path`` that shows what lies there now.

    An external entry with another schema or place is changed in place, so that the table is always found;
    one of another format or with other partition columns is replaced. Files are not touched. An
    entry that still fits is refreshed. A managed table or a view of that name is an error:
    dropping a managed table would delete its files. With ``schema`` the folder may
    still be empty.
    """
    wanted = schema or spark.read.format(fmt).options(**options).load(path).schema
    if spark.catalog.tableExists(table):
        detail = _detail(spark, table)
        if detail.get("Type") != "EXTERNAL":
            raise ValueError(f"{table} exists and is no external table: {detail.get('Type')}")
        if not _fits(spark, table, detail, wanted, path):
            if partition_by or _partitioned(spark, table) or detail.get("Provider", "").lower() != fmt.lower():
                spark.sql(f"DROP TABLE {table}")
            else:
                _change(spark, table, detail, wanted, path)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in wanted)
    partitions = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    settings = ", ".join(f"{_text(k)} {_text(str(v))}" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} "
        + (f"OPTIONS ({settings}) " if settings else "")
        + f"{partitions} LOCATION {_text(path)}"
    )
    if partition_by and fmt in FILE_FORMATS and _folder_exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of ``database``, without the session's temporary views."""
    return (
        spark.sql(f"SHOW TABLES IN {quoted(database)}")
        .where(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
    )


def table_names(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def describe_tables(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of each table: its position, name and type."""
    rows = [
        (name, position, column, kind)
        for name in table_names(spark, database)
        for position, (column, kind) in enumerate(
            spark.table(f"{quoted(database)}.{quoted(name)}").dtypes, start=1
        )
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string"
    )


def _folder_exists(spark: SparkSession, path: str) -> bool:
    try:
        list_files(spark, path)
        return True
    except AnalysisException:
        return False


def _detail(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table below its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    heading = next(i for i, row in enumerate(rows) if row["col_name"].startswith("# Detailed"))
    return {row["col_name"]: row["data_type"] for row in rows[heading + 1 :]}


def _fits(
    spark: SparkSession, table: str, detail: dict[str, str], wanted: T.StructType, path: str
) -> bool:
    here = spark.table(table)
    return _same_place(detail.get("Location", ""), path) and sorted(here.dtypes) == sorted(
        (f.name, f.dataType.simpleString()) for f in wanted
    )


def _partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def _change(
    spark: SparkSession, table: str, detail: dict[str, str], wanted: T.StructType, path: str
) -> None:
    """Give an entry another place and other columns. SQL can only add columns, so the catalog is asked."""
    if not _same_place(detail.get("Location", ""), path):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
    if spark.table(table).dtypes != [(f.name, f.dataType.simpleString()) for f in wanted]:
        columns = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(wanted.json())
        catalog = spark._jsparkSession.sharedState().externalCatalog()
        catalog.alterTableDataSchema(detail["Database"], detail["Table"], columns)


def _same_place(one: str, other: str) -> bool:
    """The same folder, where one of the two may leave out the file system."""
    a, b = urlparse(one), urlparse(other)
    same_host = a.netloc == b.netloc or not (a.netloc and b.netloc)
    return same_host and a.path.rstrip("/") == b.path.rstrip("/")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
