"""Catalog tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def scan_table_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None where it does not exist or cannot be resolved."""
    try:
        return spark.table(table) if spark.catalog.tableExists(table) else None
    except AnalysisException:
        return None


def sample_rows(table: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return table.limit(n)


def row_count(table: DataFrame, name: str = "count") -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias(name))
