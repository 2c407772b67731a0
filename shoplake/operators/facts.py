"""Order facts: orders joined with their items."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplake.schemas import FACT_COLUMNS


def join_order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order item, with its order. Orders and items without the other are dropped.

    Both sides shuffle on ``order_id`` unless one is small enough for Catalyst to
    broadcast; an order with very many items is split by adaptive skew handling.
    """
    sides = {"orders": orders.alias("orders"), "items": items.alias("items")}
    columns = [sides[side][f"{side}.{name}"] for side, name in FACT_COLUMNS]
    on = sides["orders"]["orders.order_id"] == sides["items"]["items.order_id"]
    return sides["orders"].join(sides["items"], on, "inner").select(*columns)
