"""Shaped events from catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplake.config import LakeConfig
from shoplake.operators.events import product_ids, shape_events


def shaped_events(spark: SparkSession, cfg: LakeConfig, activity: DataFrame) -> DataFrame:
    """Events of ``activity``, a batch or a stream, with products of the product table."""
    return shape_events(activity, product_ids(spark.table(cfg.table(cfg.products_table))))
