"""Daily order metrics, computed and published."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.config import FACT_DAYS_TABLE, FACT_TABLE, METRICS_TABLE, LakeConfig
from shoplake.functions.temporal import as_date
from shoplake.operators.daily import (
    ORDER_DATE,
    facts_on_date,
    facts_on_latest_date,
    latest_order_date,
    metrics_per_day,
)
from shoplake.schemas import METRICS_SCHEMA
from shoplake.sinks.catalog import create_database
from shoplake.sinks.snapshots import replace_table

REPLACE_DATE = "replace_date"
APPEND = "append"


def daily_metrics(facts: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Metrics of ``day``, or of the newest day: one row, or none where there are no facts."""
    chosen = facts_on_latest_date(facts) if day is None else facts_on_date(facts, day)
    return metrics_per_day(chosen)


def newest_day(spark: SparkSession, cfg: LakeConfig) -> dt.date | None:
    """The newest day with facts, from the table of days that is built with them."""
    if spark.catalog.tableExists(cfg.table(FACT_DAYS_TABLE)):
        return spark.table(cfg.table(FACT_DAYS_TABLE)).agg(F.max(ORDER_DATE)).first()[0]
    return latest_order_date(spark.table(cfg.table(FACT_TABLE))).first()[0]


def latest_daily_metrics(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Metrics of the newest day of the stored facts, read from the files of that day only."""
    facts, day = spark.table(cfg.table(FACT_TABLE)), newest_day(spark, cfg)
    return daily_metrics(facts.limit(0) if day is None else facts, day)


def publish_daily_metrics(
    spark: SparkSession,
    cfg: LakeConfig,
    day: dt.date | str | None = None,
    write_mode: str = REPLACE_DATE,
) -> DataFrame:
    """Compute the metrics of a day from the stored facts, write them, return them read back.

    ``replace_date`` replaces the day's row, so a rerun changes nothing; a named day that
    no longer has facts loses its row. ``append`` adds a row at each run. The table has a row or a few for each day,
    so it is written anew as one file, and readers see it before or after.
    """
    if write_mode not in (REPLACE_DATE, APPEND):
        raise ValueError(f"unknown write mode {write_mode!r}")
    day = newest_day(spark, cfg) if day is None else as_date(day)
    target = metrics_table(spark, cfg)
    if day is not None:
        on_day = F.col(ORDER_DATE) == F.lit(day)
        earlier = target if write_mode == APPEND else target.where(~on_day | F.col(ORDER_DATE).isNull())
        facts = spark.table(cfg.table(FACT_TABLE))
        target = _replace(cfg, earlier.unionByName(daily_metrics(facts, day)))
    return target.where(F.col(ORDER_DATE) == F.lit(day)).select(METRICS_SCHEMA.names)


def publish_all_days(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Compute the metrics of every day, replace the whole table by them, and return it."""
    create_database(spark, cfg.database, cfg.database_folder())
    return _replace(cfg, all_daily_metrics(spark, cfg)).select(METRICS_SCHEMA.names)


def all_daily_metrics(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Metrics of every day, from the stored facts: each distinct count reads its own two columns."""
    return metrics_per_day(spark.table(cfg.table(FACT_TABLE)), one_pass=False)


def metrics_table(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The metrics table, created where it does not exist yet."""
    create_database(spark, cfg.database, cfg.database_folder())
    name = cfg.table(METRICS_TABLE)
    if spark.catalog.tableExists(name):
        return spark.table(name).select(METRICS_SCHEMA.names)
    return _replace(cfg, spark.createDataFrame([], METRICS_SCHEMA))


def _replace(cfg: LakeConfig, metrics: DataFrame) -> DataFrame:
    """One file: there is a row, or one for each run, for each day."""
    ordered = metrics.select(METRICS_SCHEMA.names).coalesce(1).sortWithinPartitions(ORDER_DATE)
    return replace_table(ordered, cfg.table(METRICS_TABLE), cfg.presentation(METRICS_TABLE), cfg.fmt)
