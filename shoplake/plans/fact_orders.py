"""The stored order facts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoplake.config import FACT_DAYS_TABLE, FACT_TABLE, LakeConfig, scratch_dir
from shoplake.functions.temporal import day_of
from shoplake.operators.daily import ORDER_DATE, ORDER_MONTH, PURCHASED_AT
from shoplake.operators.facts import join_order_items
from shoplake.session import MAX_SHUFFLE_PARTITIONS
from shoplake.sinks.catalog import create_database, register_external
from shoplake.sinks.files import overwrite
from shoplake.sinks.snapshots import replace_table

#: Rows of a file, about. Small tables have smaller files, so that all cores take part.
ROWS_PER_FILE, LEAST_ROWS_PER_FILE = 1_000_000, 50_000
#: Parts of a day that are counted, to find rows that repeat very often.
PARTS = 64
HASH, COPY, FILE = "_hash", "_copy", "_file"


def build_fact_orders(
    spark: SparkSession,
    cfg: LakeConfig,
    orders: DataFrame | None = None,
    items: DataFrame | None = None,
) -> DataFrame:
    """Join orders with items into the fact table, replacing it, and return the table.

    The files are laid out by time of purchase (``in_files``): a day lies in few files, and its query
    skips the others by their statistics. A table of the days goes with the facts, so that the newest one is known without
    a pass over them. Readers see the old facts or the new ones (``replace_table``), except by month: partitions are
    overwritten where they are. ``cfg.fact_by_month`` also puts each month in its own
    folder, which adds the partition column ``order_month``; with it a query for one day does
    not even list the files of other months.
    """
    orders = spark.table(cfg.table(cfg.orders_table)) if orders is None else orders
    items = spark.table(cfg.table(cfg.items_table)) if items is None else items
    path = cfg.processed(FACT_TABLE)
    facts = join_order_items(orders, items)
    partitions: tuple[str, ...] = ()
    if cfg.fact_by_month:
        facts = facts.withColumn(ORDER_MONTH, F.trunc(PURCHASED_AT, "month"))
        partitions = (ORDER_MONTH,)
    laid_out, days = in_files(facts)
    laid_out = laid_out.drop(HASH, COPY, FILE)
    create_database(spark, cfg.database, cfg.database_folder())
    if partitions:
        overwrite(laid_out, path, cfg.fmt, partitions)
        told = register_external(
            spark, cfg.table(FACT_TABLE), path, cfg.fmt, laid_out.schema, partitions
        )
    else:
        told = replace_table(laid_out, cfg.table(FACT_TABLE), path, cfg.fmt)
    replace_table(
        days.select(F.col("day").alias(ORDER_DATE), F.col("n").alias("n_facts")).coalesce(1),
        cfg.table(FACT_DAYS_TABLE),
        cfg.processed(FACT_DAYS_TABLE),
        cfg.fmt,
    )
    return told


def in_files(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``facts`` dealt to files that hold ranges of days, and within a day ranges of a hash of all columns.

    Where a row goes follows from its content and from how many rows its own day and the days before have. It depends
    neither on the order of rows nor on a sample, so a task that is run again deals the same
    rows to the same files. Rows that are equal in all columns share a hash; where they make up a
    large part of a day, the numbers spread them that they got when the joined rows were
    stored. The join is stored once, before the counts, and not run again.

    The second result has a row for each day: day and n, its number of facts.
    """
    spark = facts.sparkSession
    path = scratch_dir(spark, "facts")
    numbered = facts.withColumns({HASH: F.xxhash64(*facts.columns), COPY: F.monotonically_increasing_id()})
    seen = Observation()
    numbered.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path)
    total = seen.get["rows"]
    files = n_files(spark, total)
    counted, place_of_days = counted_days(rows, total / files), scratch_dir(spark, "days")
    counted.coalesce(1).write.parquet(place_of_days)
    days = spark.read.schema(counted.schema).parquet(place_of_days)
    part = F.shiftrightunsigned(HASH, 58)
    repeated = F.array_contains("often", part)
    bits = F.shiftrightunsigned(F.when(repeated, F.xxhash64(HASH, COPY)).otherwise(F.col(HASH)), 11)
    place = F.col("before") + bits / F.lit(float(1 << 53)) * F.col("n")
    file = F.least(F.floor(place * F.lit(files / max(total, 1))).cast("int"), F.lit(files - 1))
    dealt = rows.join(F.broadcast(days), day_of(PURCHASED_AT).eqNullSafe(days["day"]))
    dealt = dealt.withColumn(FILE, file).select(*rows.columns, FILE)
    return dealt.repartitionById(files, FILE).sortWithinPartitions(PURCHASED_AT), days


def counted_days(rows: DataFrame, per_file: float) -> DataFrame:
    """(day, n, before, often) of every day: its rows, those of earlier days, and the parts of its hashes that hold more than their
    share and half a file at least. There is one short row per day, so the table is small."""
    counts = rows.groupBy(
        day_of(PURCHASED_AT).alias("day"), F.shiftrightunsigned(HASH, 58).alias("part")
    ).agg(F.count(F.lit(1)).alias("n"))
    days = counts.groupBy("day").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("part", "n")).alias("parts")
    )
    large = F.filter("parts", lambda p: (p["n"] > per_file / 2) & (p["n"] * PARTS > 3 * F.col("n")))
    before = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    return days.select(
        "day",
        "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.transform(large, lambda p: p["part"]).alias("often"),
    )


def n_files(spark: SparkSession, rows: int) -> int:
    """As many as ``rows`` need; where adaptive execution may not merge partitions, as many as a shuffle has."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    least = min(width, math.ceil(rows / LEAST_ROWS_PER_FILE)) if merged else width
    return max(1, min(max(least, math.ceil(rows / ROWS_PER_FILE)), MAX_SHUFFLE_PARTITIONS))
