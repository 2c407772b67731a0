"""Column names and types of the tables and events."""

from __future__ import annotations

from pyspark.sql import types as T

# The event record, in field order.
EVENT_FIELDS = [
    ("event_id", "string"),
    ("event_type", "string"),
    ("user_id", "string"),
    ("product_id", "string"),
    ("timestamp", "string"),
    ("session_id", "string"),
    ("view_duration_seconds", "int"),
    ("quantity", "int"),
    ("cart_value_cents", "int"),
    ("items_count", "int"),
    ("purchase_value_cents", "int"),
    ("payment_method", "string"),
    ("search_query", "string"),
]

# Event vocabulary.
PRODUCT_VIEW = "product_view"
ADD_TO_CART = "add_to_cart"
CHECKOUT = "checkout"
PURCHASE = "purchase"
PRODUCT_SEARCH = "product_search"
EVENT_TYPES = [PRODUCT_VIEW, ADD_TO_CART, CHECKOUT, PURCHASE, PRODUCT_SEARCH]

# Columns of the fact table by the side of the join they come from, in output order.
FACT_COLUMNS = [
    ("orders", "order_id"),
    ("orders", "customer_id"),
    ("items", "seller_id"),
    ("items", "product_id"),
    ("orders", "order_status"),
    ("orders", "order_purchase_timestamp"),
    ("orders", "order_approved_at"),
    ("orders", "order_delivered_carrier_date"),
    ("orders", "order_delivered_customer_date"),
    ("orders", "order_estimated_delivery_date"),
    ("items", "price"),
    ("items", "freight_value"),
    ("items", "shipping_limit_date"),
]

# Columns of the daily metrics table.
METRICS_FIELDS = [
    ("order_date", "date"),
    ("total_orders", "bigint"),
    ("unique_customers", "bigint"),
    ("total_sales", "double"),
    ("avg_order_value", "double"),
    ("total_shipping", "double"),
    ("unique_products", "bigint"),
]

CORRUPT_RECORD = "_corrupt_record"
PROCESSING_TIME = "processing_time"

# Types of the CSV columns the queries use. Times are zone-free and money is exact, so
# results depend neither on the session time zone nor on the order of summation.
KNOWN_COLUMN_TYPES = {
    "order_id": "string",
    "customer_id": "string",
    "seller_id": "string",
    "product_id": "string",
    "order_status": "string",
    "order_purchase_timestamp": "timestamp_ntz",
    "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
    "shipping_limit_date": "timestamp_ntz",
    "price": "decimal(18,6)",
    "freight_value": "decimal(18,6)",
}


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def struct_of(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


EVENT_SCHEMA = struct_of(EVENT_FIELDS)
METRICS_SCHEMA = struct_of(METRICS_FIELDS)


def raw_events_schema(event_schema: T.StructType = EVENT_SCHEMA) -> T.StructType:
    return T.StructType([*event_schema.fields, T.StructField(PROCESSING_TIME, T.TimestampType())])
