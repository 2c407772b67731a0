"""The given tables, under the column names of the shop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake import schemas as S
from shoplake.config import LakeConfig, scratch_dir
from shoplake.functions import payload

BATCH_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Event types of the given data and the shop event each stands for.
EVENT_TYPE_MAP = {
    "view": S.PRODUCT_VIEW,
    "click": S.ADD_TO_CART,
    "error": S.CHECKOUT,
    "purchase": S.PURCHASE,
    "signup": S.PRODUCT_SEARCH,
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(given_path(sf_dir, name))


def given_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def fresh_config(spark: SparkSession, label: str, **settings) -> LakeConfig:
    """A lakehouse of its own for one query, in the shared scratch folder."""
    root = scratch_dir(spark, label)
    return LakeConfig(root=root, database=root.rsplit("/", 1)[-1].replace("-", "_"), **settings)


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the given data has no approval, delivery and estimate times."""
    unknown = F.lit(None).cast("timestamp_ntz")
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        unknown.alias("order_approved_at"),
        unknown.alias("order_delivered_carrier_date"),
        unknown.alias("order_delivered_customer_date"),
        unknown.alias("order_estimated_delivery_date"),
    )


def shop_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items; freight is stood in for by the tax amount."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("freight_value"),
        F.col("l_shipdate").alias("shipping_limit_date"),
    )


def shop_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"))


def shop_activity(events: DataFrame) -> DataFrame:
    """Rows of the given events (batch or stream) with the shop's event types.

    The number in ``props`` stands for the product: the part table knows some of them.
    """
    pairs = [F.lit(x) for pair in EVENT_TYPE_MAP.items() for x in pair]
    return events.select(
        "event_id",
        F.create_map(*pairs)[F.col("event_type")].alias("event_type"),
        "user_id",
        "ts",
        "value",
        payload.json_int("props", "k").alias("product_id"),
    )
