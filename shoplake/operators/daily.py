"""Aggregates over order facts."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions.temporal import as_date, day_of
from shoplake.schemas import METRICS_FIELDS

PURCHASED_AT = "order_purchase_timestamp"
ORDER_DATE = "order_date"
ORDER_MONTH = "order_month"


def latest_order_date(facts: DataFrame) -> DataFrame:
    """One row; NULL where there are no dated facts."""
    return facts.agg(day_of(F.max(PURCHASED_AT)).alias("latest_date"))


def facts_on_date(facts: DataFrame, day: dt.date | str) -> DataFrame:
    """Facts of one day. Facts stored by month are read from that month's partition only."""
    day = as_date(day)
    on_day = facts.where(day_of(PURCHASED_AT) == F.lit(day))
    if ORDER_MONTH in facts.columns:
        on_day = on_day.where(F.col(ORDER_MONTH) == F.lit(day.replace(day=1)))
    return on_day


def facts_on_latest_date(facts: DataFrame) -> DataFrame:
    """Facts of the newest day. Everything since that day began belongs to it.

    The subqueries give values of the compared columns' own types, so the comparisons
    reach the file scan and skip partitions and row groups of older days.
    """
    if ORDER_MONTH in facts.columns:
        dated = facts.where(F.col(ORDER_MONTH).isNotNull())
        facts = dated.where(F.col(ORDER_MONTH) == dated.agg(F.max(ORDER_MONTH)).scalar())
    kind = facts.schema[PURCHASED_AT].dataType
    day_start = facts.agg(day_of(F.max(PURCHASED_AT)).cast(kind)).scalar()
    return facts.where(F.col(PURCHASED_AT) >= day_start)


def orders_per_day(facts: DataFrame) -> DataFrame:
    """Distinct orders and order items of each day."""
    return facts.groupBy(day_of(PURCHASED_AT).alias(ORDER_DATE)).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("total_items"),
    )


DISTINCT_COUNTS = {
    "total_orders": "order_id",
    "unique_customers": "customer_id",
    "unique_products": "product_id",
}


def metrics_per_day(facts: DataFrame, one_pass: bool = True) -> DataFrame:
    """The seven daily metrics, one row per day. ``avg_order_value`` is the mean item price.

    ``one_pass`` reads the facts once, which suits one day, or facts that are not stored but
    joined on the way. Over all days of stored facts ``one_pass=False`` is faster.
    """
    sums = [
        F.sum("price").alias("sales"),
        F.count("price").alias("priced_items"),
        F.sum("freight_value").alias("shipping"),
    ]
    if one_pass:
        counts = [F.count_distinct(c).alias(name) for name, c in DISTINCT_COUNTS.items()]
        measured = facts.groupBy(day_of(PURCHASED_AT).alias(ORDER_DATE)).agg(*sums, *counts)
    else:
        measured = _by_column(facts, sums)
    sales = F.col("sales").cast("double")
    return measured.select(
        ORDER_DATE,
        "total_orders",
        "unique_customers",
        sales.alias("total_sales"),
        F.try_divide(sales, F.col("priced_items")).alias("avg_order_value"),
        F.col("shipping").cast("double").alias("total_shipping"),
        "unique_products",
    ).select(*[name for name, _ in METRICS_FIELDS])


def _by_column(facts: DataFrame, sums: list[Column]) -> DataFrame:
    """Sums and distinct counts per day, each read from only the columns it needs.

    Several COUNT(DISTINCT)s in one aggregate copy every row once per count, with all columns.
    Here each count first reduces (day, id) pairs within the tasks, then spreads them over
    the cluster by both columns: neither a hot day nor a hot id meets in one task. What is left
    is one short row per day and branch.
    """
    day = day_of(PURCHASED_AT).alias(ORDER_DATE)
    branches = [facts.groupBy(day).agg(*sums)]
    for name, column in DISTINCT_COUNTS.items():
        pairs = facts.select(day, F.col(column).alias("id")).distinct()
        branches.append(pairs.groupBy(ORDER_DATE).agg(F.count("id").alias(name)))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return merged.groupBy(ORDER_DATE).agg(
        *[F.max(c).alias(c) for c in merged.columns if c != ORDER_DATE]
    )
