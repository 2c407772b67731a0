"""Facts and daily metrics of the small shop."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from conftest import rows
from fixtures import ITEMS, JAN_1, JAN_2, ORDERS, build_shop, write_raw
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplake.operators.daily import (
    facts_on_date,
    latest_order_date,
    metrics_per_day,
    orders_per_day,
)
from shoplake.plans.daily_metrics import (
    APPEND,
    daily_metrics,
    metrics_table,
    latest_daily_metrics,
    newest_day,
    publish_all_days,
    publish_daily_metrics,
)
from shoplake.plans.fact_orders import build_fact_orders
from shoplake.plans.ingest import ingest_csv
from shoplake.schemas import FACT_COLUMNS

BY_MONTH = [False, True]


@pytest.fixture(params=BY_MONTH, ids=["flat", "by_month"])
def shop(spark, cfg, request):
    cfg = dataclasses.replace(cfg, fact_by_month=request.param)
    return cfg, build_shop(spark, cfg)


def test_fact_columns_and_rows(spark, cfg):
    facts = build_shop(spark, cfg)
    assert facts.columns == [name for _, name in FACT_COLUMNS]
    assert rows(facts.select("order_id", "product_id")) == [
        ("o1", "p1"),
        ("o2", "p1"),
        ("o2", "p2"),
        ("o3", "p2"),
        ("o5", "p3"),
    ]
    first = facts.where("order_id = 'o1'").first()
    assert first.order_approved_at == dt.datetime(2018, 1, 1, 10, 5)
    assert first.order_estimated_delivery_date == dt.datetime(2018, 1, 10)
    assert first.shipping_limit_date == dt.datetime(2018, 1, 4)


def test_null_keys_never_join(spark, cfg):
    no_key = ORDERS + ",c9,created,2018-01-09 00:00:00,,,,\n"
    facts = build_shop(spark, cfg, no_key, ITEMS + ",p9,s9,2018-01-04 00:00:00,1.00,1.00\n")
    assert facts.count() == 5


def test_latest_date_ignores_undated_and_itemless_orders(spark, shop):
    _, facts = shop
    assert rows(latest_order_date(facts)) == [(dt.date(2018, 1, 2),)]


def test_metrics(spark, shop):
    _, facts = shop
    assert rows(daily_metrics(facts)) == [JAN_2]
    assert rows(daily_metrics(facts, "2018-01-01")) == [JAN_1]
    assert rows(daily_metrics(facts, dt.date(2018, 1, 2))) == [JAN_2]
    assert rows(daily_metrics(facts, "2018-01-03")) == []


def test_undated_facts_are_their_own_group(spark, shop):
    _, facts = shop
    undated = (None, 1, 1, 7.0, 7.0, 0.1, 1)
    for one_pass in (True, False):
        got = metrics_per_day(facts, one_pass)
        assert rows(got) == sorted([JAN_1, JAN_2, undated], key=repr)


def test_orders_per_day(spark, shop):
    _, facts = shop
    by_day = orders_per_day(facts).where("order_date IS NOT NULL")
    assert rows(by_day) == [(dt.date(2018, 1, 1), 1, 1), (dt.date(2018, 1, 2), 2, 3)]


def test_empty_facts(spark, cfg):
    facts = build_shop(spark, cfg, items=ITEMS.splitlines()[0] + "\n")
    assert rows(latest_order_date(facts)) == [(None,)]
    assert rows(daily_metrics(facts)) == []
    assert rows(publish_daily_metrics(spark, cfg)) == []


def test_all_prices_missing(spark, cfg):
    facts = build_shop(spark, cfg, items=ITEMS.splitlines()[0] + "\no1,p1,s1,,,\n")
    assert rows(daily_metrics(facts)) == [(dt.date(2018, 1, 1), 1, 1, None, None, None, 1)]


def test_rerun_replaces_the_day(spark, shop):
    cfg, _ = shop
    publish_daily_metrics(spark, cfg, "2018-01-01")
    for _ in range(2):
        assert rows(publish_daily_metrics(spark, cfg)) == [JAN_2]
    assert rows(metrics_table(spark, cfg).select(*"""order_date total_orders unique_customers
        total_sales avg_order_value total_shipping unique_products""".split())) == [JAN_1, JAN_2]


def test_append_keeps_every_run(spark, cfg):
    build_shop(spark, cfg)
    for _ in range(2):
        published = publish_daily_metrics(spark, cfg, write_mode=APPEND)
    assert rows(published) == [JAN_2, JAN_2]


def test_day_that_lost_its_orders_loses_its_row(spark, cfg):
    build_shop(spark, cfg)
    publish_daily_metrics(spark, cfg, "2018-01-01")
    publish_daily_metrics(spark, cfg, "2018-01-02")
    write_raw(cfg, order_items="\n".join(r for r in ITEMS.splitlines() if "o1" not in r) + "\n")
    ingest_csv(spark, "order_items.csv", cfg)
    build_fact_orders(spark, cfg)
    assert rows(publish_daily_metrics(spark, cfg, "2018-01-01")) == []
    assert [r.order_date for r in metrics_table(spark, cfg).collect()] == [dt.date(2018, 1, 2)]


def test_days_do_not_depend_on_the_time_zone(spark, cfg):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        build_shop(spark, cfg)
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        facts = spark.table(cfg.table("fact_orders"))
        assert rows(daily_metrics(facts)) == [JAN_2]
        assert rows(publish_daily_metrics(spark, cfg, "2018-01-01")) == [JAN_1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rebuilt_facts_are_seen(spark, cfg):
    build_shop(spark, cfg)
    more = ITEMS + "o4,p4,s1,2018-01-04 00:00:00,3.00,0.50\n"
    facts = build_shop(spark, cfg, items=more)
    assert facts.count() == 6
    assert rows(latest_order_date(facts)) == [(dt.date(2018, 1, 3),)]


def test_month_that_lost_its_orders(spark, cfg):
    cfg = dataclasses.replace(cfg, fact_by_month=True)
    later = ORDERS + "o6,c1,created,2018-02-01 00:00:00,,,,\n"
    facts = build_shop(spark, cfg, later, ITEMS + "o6,p1,s1,,1.00,1.00\n")
    assert rows(latest_order_date(facts)) == [(dt.date(2018, 2, 1),)]
    build_shop(spark, cfg)
    assert rows(publish_daily_metrics(spark, cfg)) == [JAN_2]
    months = spark.sql(f"SHOW PARTITIONS {cfg.table('fact_orders')}")
    assert "order_month=2018-02-01" not in {r[0] for r in months.collect()}


def test_bad_arguments(spark, cfg):
    facts = build_shop(spark, cfg)
    with pytest.raises(ValueError):
        daily_metrics(facts, "2018-01-01' OR 'a' = 'a")
    with pytest.raises(ValueError):
        publish_daily_metrics(spark, cfg, write_mode="merge")


def test_layout_is_sorted_by_time(spark, cfg):
    build_shop(spark, cfg)
    files = spark.table(cfg.table("fact_orders"))
    times = [r[0] for r in files.select("order_purchase_timestamp").collect() if r[0]]
    assert times == sorted(times)


item = st.tuples(
    st.integers(0, 6),
    st.integers(0, 3),
    st.integers(0, 4),
    st.one_of(st.none(), st.integers(1, 4)),
    st.one_of(st.none(), st.integers(0, 10_000)),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(item, max_size=25))
def test_metrics_against_brute_force(spark, items):
    facts = spark.createDataFrame(
        items, "o int, c int, p int, d int, cents int"
    ).select(
        F.col("o").cast("string").alias("order_id"),
        F.col("c").cast("string").alias("customer_id"),
        F.col("p").cast("string").alias("product_id"),
        F.expr("make_timestamp_ntz(2020, 1, d, 1, 2, 3)").alias("order_purchase_timestamp"),
        (F.col("cents") / 100).cast("decimal(18,2)").alias("price"),
        (F.col("cents") / 100).cast("decimal(18,2)").alias("freight_value"),
    )
    want = []
    for day in {i[3] for i in items}:
        mine = [i for i in items if i[3] == day]
        cents = [i[4] for i in mine if i[4] is not None]
        total = sum(cents) / 100 if cents else None
        want.append(
            (
                dt.date(2020, 1, day) if day else None,
                len({i[0] for i in mine}),
                len({i[1] for i in mine}),
                total,
                total / len(cents) if cents else None,
                total,
                len({i[2] for i in mine}),
            )
        )
    for one_pass in (True, False):
        assert rows(metrics_per_day(facts, one_pass)) == sorted(want, key=repr)
    dated = [w for w in want if w[0]]
    if dated:
        newest = max(dated, key=lambda w: w[0])
        assert rows(daily_metrics(facts)) == [newest]
        assert rows(metrics_per_day(facts_on_date(facts, newest[0]))) == [newest]


def test_all_days_are_one_file(spark, shop):
    cfg, facts = shop
    told = publish_all_days(spark, cfg)
    assert rows(told.where("order_date IS NOT NULL")) == [JAN_1, JAN_2]
    assert told.count() == rows(facts.selectExpr("count(DISTINCT to_date(order_purchase_timestamp)) + 1"))[0][0]
    assert told.select(F.input_file_name()).distinct().count() == 1
    assert rows(publish_daily_metrics(spark, cfg, "2018-01-01")) == [JAN_1]
    assert metrics_table(spark, cfg).count() == told.count()


def test_newest_day_needs_no_pass_over_the_facts(spark, shop):
    cfg, facts = shop
    assert newest_day(spark, cfg) == dt.date(2018, 1, 2)
    latest = latest_daily_metrics(spark, cfg)
    assert rows(latest) == [JAN_2]
    shown = latest._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp,2018-01-02T00:0" in shown
    assert "Subquery" not in shown


def test_newest_day_of_no_facts(spark, cfg):
    build_shop(spark, cfg, items=ITEMS.splitlines()[0] + "\n")
    assert newest_day(spark, cfg) is None and rows(latest_daily_metrics(spark, cfg)) == []
