"""CSV files of the raw zone to catalog tables of the processed zone."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from shoplake.config import LakeConfig
from shoplake.sinks.catalog import create_database
from shoplake.sinks.files import overwrite
from shoplake.sinks.snapshots import replace_table
from shoplake.sources.csv_files import (
    CSV_SUFFIX,
    count_lost,
    discover_csv,
    lost_values,
    scan_csv,
    scan_texts,
    typed,
)

log = logging.getLogger(__name__)
SAMPLE_ROWS = 5
REJECTS = "_rejects"


def ingest_csv(
    spark: SparkSession, file_name: str, cfg: LakeConfig, show: bool = False
) -> DataFrame:
    """Load one raw CSV entry into its table, replacing earlier content, and return the table.

    Values that their type cannot hold are counted while the table is written. If there are any,
    their texts are kept in ``<table>_rejects``, which takes a second reading of the file.
    """
    table = file_name.removesuffix(CSV_SUFFIX)
    create_database(spark, cfg.database, cfg.database_folder())
    path, source, types = cfg.processed(table), cfg.raw(file_name), cfg.column_types
    many = table in cfg.multi_line_tables
    rejects = cfg.processed(f"{table}{REJECTS}")
    if types:
        texts = scan_texts(spark, source, types, many)
        seen = Observation()
        rows = texts.observe(seen, count_lost(texts, types)).select(*typed(texts, types))
        loaded = replace_table(rows, cfg.table(table), path, cfg.fmt)
        overwrite(lost_values(texts if seen.get["lost"] else texts.limit(0), types), rejects, cfg.fmt)
        if seen.get["lost"]:
            log.warning("%s values of %s did not fit: see %s", seen.get["lost"], file_name, rejects)
    else:
        loaded = replace_table(scan_csv(spark, source, multi_line=many), cfg.table(table), path, cfg.fmt)
    log.info("loaded %s into %s", file_name, cfg.table(table))
    if show:
        loaded.printSchema()
        loaded.show(SAMPLE_ROWS)
    return loaded


def ingest_all(spark: SparkSession, cfg: LakeConfig, at_once: int = 4) -> dict[str, DataFrame]:
    """Load every CSV entry of the raw zone, ``at_once`` Spark jobs side by side."""
    names = sorted(row.file_name for row in discover_csv(spark, cfg.raw()).collect())
    create_database(spark, cfg.database, cfg.database_folder())
    with ThreadPoolExecutor(max_workers=at_once) as jobs:
        loaded = jobs.map(lambda name: ingest_csv(spark, name, cfg), names)
        return {name.removesuffix(CSV_SUFFIX): table for name, table in zip(names, loaded)}
