"""A small shop with every awkward case: missing dates, orders without items, orphan items."""

from __future__ import annotations

import datetime as dt

from shoplake.plans.fact_orders import build_fact_orders

ORDERS = """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,\
order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 10:05:00,2018-01-02 09:00:00,2018-01-05 18:00:00,2018-01-10 00:00:00
o2,c2,shipped,2018-01-02 00:00:00,,,,
o3,c1,delivered,2018-01-02 23:59:59,,,,
o4,c3,canceled,2018-01-03 08:00:00,,,,
o5,c4,created,,,,,
"""
ITEMS = """order_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,p1,s1,2018-01-04 00:00:00,10.00,1.00
o2,p1,s1,2018-01-04 00:00:00,20.00,2.00
o2,p2,s2,2018-01-04 00:00:00,30.50,2.50
o3,p2,s2,2018-01-04 00:00:00,5.25,0.75
o5,p3,s1,2018-01-04 00:00:00,7.00,0.10
o9,p1,s1,2018-01-04 00:00:00,1.00,0.10
"""
JAN_1 = (dt.date(2018, 1, 1), 1, 1, 10.0, 10.0, 1.0, 1)
JAN_2 = (dt.date(2018, 1, 2), 2, 2, 55.75, 55.75 / 3, 5.25, 2)


def write_raw(cfg, **files: str) -> None:
    from pathlib import Path

    Path(cfg.raw()).mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        Path(cfg.raw(f"{name}.csv")).write_text(text, encoding="utf-8")


def build_shop(spark, cfg, orders: str = ORDERS, items: str = ITEMS):
    from shoplake.plans.ingest import ingest_all

    write_raw(cfg, orders=orders, order_items=items)
    ingest_all(spark, cfg)
    return build_fact_orders(spark, cfg)
