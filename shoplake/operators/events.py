"""Shop events from activity rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake import schemas as S
from shoplake.functions.temporal import iso_text
from shoplake.functions.values import cents, prefixed


def shape_events(activity: DataFrame, products: DataFrame) -> DataFrame:
    """Events of 13 fields from activity rows (event_id, event_type, user_id, ts, value, product_id).

    Every value comes from the row. ``activity`` may also have session_id, view_duration_seconds, quantity, items_count,
    payment_method and search_query: a session belongs to all events, each of the others to its type of
    event; a number that is none, or has no room, is NULL. A product is named if ``products`` (a table with distinct
    ``product_id``) knows it; searches have none. An amount belongs to checkouts and purchases; one
    without room in cents is NULL. Fields for which a row has no source are NULL.

    The join is a left join by id: Catalyst broadcasts a small product table and shuffles by id
    else, where adaptive execution splits a product with very many events.
    """

    def only_for(event_type: str, attribute: Column) -> Column:
        return F.when(F.col("event_type") == event_type, attribute)

    def given(column: str, kind: str) -> Column:
        if column not in activity.columns:
            return F.lit(None).cast(kind)
        return F.col(column).cast("string").try_cast(kind)

    rows = activity.withColumn("wanted", F.col("product_id").cast("string")).drop("product_id")
    known = products.select(F.col("product_id").cast("string").alias("known"))
    return rows.join(known, rows["wanted"] == known["known"], "left").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        prefixed("user_", "user_id").alias("user_id"),
        F.when(F.col("event_type") != S.PRODUCT_SEARCH, F.col("known")).alias("product_id"),
        iso_text("ts").alias("timestamp"),
        given("session_id", "string").alias("session_id"),
        only_for(S.PRODUCT_VIEW, given("view_duration_seconds", "int")).alias("view_duration_seconds"),
        only_for(S.ADD_TO_CART, given("quantity", "int")).alias("quantity"),
        only_for(S.CHECKOUT, cents("value")).alias("cart_value_cents"),
        only_for(S.CHECKOUT, given("items_count", "int")).alias("items_count"),
        only_for(S.PURCHASE, cents("value")).alias("purchase_value_cents"),
        only_for(S.PURCHASE, given("payment_method", "string")).alias("payment_method"),
        only_for(S.PRODUCT_SEARCH, given("search_query", "string")).alias("search_query"),
    )


def product_ids(products: DataFrame, column: str = "product_id") -> DataFrame:
    """The distinct product ids, as text."""
    ids = products.select(F.col(column).cast("string").alias("product_id"))
    return ids.where(F.col("product_id").isNotNull()).distinct()
