"""What is in the tables of a database."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.config import quoted
from shoplake.sinks.catalog import describe_tables, table_names
from shoplake.sources.tables import row_count, sample_rows


@dataclass(frozen=True)
class DatabaseProfile:
    columns: DataFrame
    counts: DataFrame
    samples: dict[str, DataFrame]


def count_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, count) of all tables in one job."""
    counts = [
        row_count(table).select(F.lit(name).alias("table_name"), "count")
        for name, table in tables.items()
    ]
    if not counts:
        return spark.createDataFrame([], "table_name string, count bigint")
    return reduce(DataFrame.unionByName, counts)


def profile_database(spark: SparkSession, database: str, sample: int = 10) -> DatabaseProfile:
    """Columns, row counts and sample rows of each table."""
    tables = {
        name: spark.table(f"{quoted(database)}.{quoted(name)}")
        for name in table_names(spark, database)
    }
    return DatabaseProfile(
        columns=describe_tables(spark, database),
        counts=count_tables(spark, tables),
        samples={name: sample_rows(table, sample) for name, table in tables.items()},
    )
