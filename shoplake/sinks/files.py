"""Writing tables and CSV files to zone folders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplake.sources.csv_files import TIME_FORMAT


def land_csv(df: DataFrame, path: str, **options: str) -> None:
    """Write ``df`` as headed UTF-8 CSV at ``path``, replacing what is there."""
    df.write.mode("overwrite").options(
        header=True, timestampFormat=TIME_FORMAT, timestampNTZFormat=TIME_FORMAT, **options
    ).csv(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)
