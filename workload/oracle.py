"""SQL that gives the same rows as the Spark queries, over the same tables."""

from __future__ import annotations

from workload.tables import BATCH_TABLES

ORDERS_ON = "1996-03-13"

FACT = """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_suppkey AS seller_id,
       l.l_partkey AS product_id, o.o_orderstatus AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2))
            AS DECIMAL(18,4)) AS freight_value,
       l.l_shipdate AS shipping_limit_date
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""

METRICS = """
SELECT CAST(order_purchase_timestamp AS DATE) AS order_date,
       COUNT(DISTINCT order_id) AS total_orders,
       COUNT(DISTINCT customer_id) AS unique_customers,
       CAST(SUM(price) AS DOUBLE) AS total_sales,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_order_value,
       CAST(SUM(freight_value) AS DOUBLE) AS total_shipping,
       COUNT(DISTINCT product_id) AS unique_products
FROM fact_orders {where}
GROUP BY CAST(order_purchase_timestamp AS DATE)
"""

LATEST = """WHERE CAST(order_purchase_timestamp AS DATE) =
      (SELECT CAST(MAX(order_purchase_timestamp) AS DATE) FROM fact_orders)"""
ON_DATE = f"WHERE CAST(order_purchase_timestamp AS DATE) = DATE '{ORDERS_ON}'"

SHAPED = """
WITH e AS (SELECT *, CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                  WHEN 'error' THEN 'checkout' WHEN 'signup' THEN 'product_search'
                  WHEN 'purchase' THEN 'purchase' END AS et,
             CAST(CAST(value AS DECIMAL(18,2)) * 100 AS INT) AS cents,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
shaped AS (
SELECT CAST(e.event_id AS VARCHAR) AS event_id, et AS event_type,
  concat('user_', CAST(user_id AS VARCHAR)) AS user_id,
  CASE WHEN et <> 'product_search' THEN CAST(p_partkey AS VARCHAR) END AS product_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
  CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS INT) AS view_duration_seconds,
  CAST(NULL AS INT) AS quantity,
  CASE WHEN et = 'checkout' THEN cents END AS cart_value_cents,
  CAST(NULL AS INT) AS items_count,
  CASE WHEN et = 'purchase' THEN cents END AS purchase_value_cents,
  CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS VARCHAR) AS search_query
FROM e LEFT JOIN part ON p_partkey = k)
"""


def with_fact(sql: str) -> str:
    return f"WITH fact_orders AS ({FACT}) {sql}"


def union(template: str, tables: list[str]) -> str:
    return " UNION ALL ".join(template.format(t=t) for t in tables)


FACT_OUT = """
SELECT order_id, customer_id, seller_id, product_id, order_status,
       strftime(order_purchase_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS order_purchase_timestamp,
       CAST(NULL AS VARCHAR) AS order_approved_at,
       CAST(NULL AS VARCHAR) AS order_delivered_carrier_date,
       CAST(NULL AS VARCHAR) AS order_delivered_customer_date,
       CAST(NULL AS VARCHAR) AS order_estimated_delivery_date,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
       strftime(shipping_limit_date, '%Y-%m-%dT%H:%M:%S.%f') AS shipping_limit_date
FROM fact_orders
"""
ORDERS_OUT = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate, o_orderpriority
FROM orders
"""
COUNTS = union("SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}", BATCH_TABLES)
VALUES = union(
    """SELECT '{t}' AS table_name, column_name, n_values FROM
       (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM {t}) ON * INTO NAME column_name VALUE n_values)""",
    BATCH_TABLES,
)
SPARK_TYPES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
       WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
       WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP_NS' THEN 'timestamp_ntz' END"""

ORACLE = {
    # sources
    "csv_scan": ORDERS_OUT,
    "csv_scan_inferred": "SELECT * FROM supplier",
    "csv_scan_multiline": "SELECT * FROM documents",
    "discover_raw": union(
        "SELECT '{t}.csv' AS file_name, '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}",
        BATCH_TABLES,
    ),
    "table_scan": ORDERS_OUT,
    "landing_files": SHAPED
    + "SELECT event_id, event_type, CAST(25 AS BIGINT) AS n_files, TRUE AS all_bytes FROM shaped",
    "landing_head": SHAPED + "SELECT event_id, user_id, CAST(5 AS BIGINT) AS n_shown FROM shaped",
    # sinks and catalog
    "sink_overwrite": "SELECT * FROM customer",
    "sink_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "register_external": "SELECT * FROM supplier",
    "ingest_csv": "SELECT * FROM customer",
    "ingest_all": f"{COUNTS} UNION ALL SELECT 'lineitem', l_orderkey FROM lineitem",
    "list_tables": COUNTS,
    "describe_tables": f"""SELECT table_name, ordinal_position AS position, column_name,
       {SPARK_TYPES} AS data_type, n_values FROM information_schema.columns
       JOIN ({VALUES}) v USING (table_name, column_name)""",
    "table_counts": COUNTS,
    "sample_rows": union(
        """SELECT '{t}' AS table_name, LEAST(COUNT(*), 10) AS n_sampled,
           LEAST(COUNT(*), 10) AS n_known FROM {t}""",
        BATCH_TABLES,
    ),
    # facts and metrics
    "fact_orders": with_fact(FACT_OUT),
    "fact_orders_by_month": with_fact(
        FACT_OUT.replace(
            "FROM fact_orders",
            ", CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month FROM fact_orders",
        )
    ),
    "orders_on_date": with_fact(
        f"""SELECT order_id, customer_id, seller_id, product_id, CAST(price AS DOUBLE) AS price
            FROM fact_orders {ON_DATE}"""
    ),
    "orders_per_day": with_fact(
        """SELECT CAST(order_purchase_timestamp AS DATE) AS order_date,
           COUNT(DISTINCT order_id) AS total_orders, COUNT(*) AS total_items
           FROM fact_orders GROUP BY CAST(order_purchase_timestamp AS DATE)"""
    ),
    "latest_order_date": with_fact(
        "SELECT CAST(MAX(order_purchase_timestamp) AS DATE) AS latest_date FROM fact_orders"
    ),
    "distinct_counts": with_fact(
        f"""SELECT order_date, total_orders, unique_customers, unique_products
            FROM ({METRICS.format(where="")})"""
    ),
    "sales_sums": with_fact(
        f"""SELECT order_date, total_sales, total_shipping, avg_order_value
            FROM ({METRICS.format(where="")})"""
    ),
    "daily_order_metrics_latest": with_fact(METRICS.format(where=LATEST)),
    "daily_order_metrics_date": with_fact(METRICS.format(where=ON_DATE)),
    "daily_order_metrics_all": with_fact(METRICS.format(where="")),
    "daily_order_metrics_publish_all": with_fact(METRICS.format(where="")),
    "daily_order_metrics_rerun": with_fact(METRICS.format(where=LATEST)),
    "daily_order_metrics_append": with_fact(
        f"""SELECT * FROM ({METRICS.format(where=LATEST)}) UNION ALL
            SELECT * FROM ({METRICS.format(where=LATEST)})"""
    ),
    "daily_order_metrics_by_month": with_fact(METRICS.format(where=LATEST)),
    # scalar functions
    "scalar_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders",
    "scalar_date_text": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text
       FROM orders""",
    "scalar_iso_text": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso
       FROM events""",
    "scalar_prefixed_id": """SELECT event_id, concat('user_', CAST(1000 + user_id AS VARCHAR)) AS id
       FROM events""",
    "scalar_cents": """SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS INT) AS cents
       FROM events""",
    "event_ids_unique": """SELECT COUNT(event_id) AS n_events, COUNT(*) AS n_ids,
       CAST(36 AS INT) AS id_length FROM events""",
    "json_parse": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k
       FROM events""",
    "utf8_roundtrip": "SELECT doc_id, text, octet_length(encode(text)) AS n_bytes FROM documents",
    # events
    "product_pool": "SELECT CAST(p_partkey AS VARCHAR) AS product_id FROM part",
    "peek_events": SHAPED + "SELECT *, TRUE AS indented FROM shaped",
    "shape_events": SHAPED + "SELECT * FROM shaped",
    "events_to_json": SHAPED + "SELECT * FROM shaped",
    # streams
    "bridge_events": SHAPED + "SELECT * FROM shaped",
    "stream_json_ingest": SHAPED + "SELECT *, TRUE AS has_processing_time FROM shaped",
    "stream_batches": SHAPED
    + """SELECT event_id, CAST(3 AS BIGINT) AS n_batches, (SELECT COUNT(*) FROM events) AS n_input_rows,
         'SUCCESS' AS outcome FROM shaped""",
    "stream_bus": SHAPED + "SELECT * FROM shaped",
    "stream_landed_by_two": SHAPED + "SELECT * FROM shaped",
    "stream_restart": SHAPED + "SELECT * FROM shaped",
    "stream_schema_evolution": SHAPED
    + """SELECT event_id, CAST(NULL AS VARCHAR) AS product_id FROM shaped
         UNION ALL SELECT event_id, product_id FROM shaped""",
    "stream_rejects": """SELECT 'kept' AS kind, COUNT(*) AS n FROM events
       WHERE event_type <> 'error'
       UNION ALL SELECT 'rejected' AS kind, COUNT(*) AS n FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'no_quantity' AS kind, COUNT(*) AS n FROM events
       WHERE event_type = 'click'
       UNION ALL SELECT 'reported_rejected' AS kind, COUNT(*) AS n FROM events
       WHERE event_type = 'error'
       UNION ALL SELECT 'reported_partial' AS kind, COUNT(*) AS n FROM events
       WHERE event_type = 'click'""",
}
