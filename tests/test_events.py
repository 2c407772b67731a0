"""Event shaping, product lookup and payloads."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shoplake import schemas as S
from shoplake.functions import payload
from shoplake.functions.payload import is_reject, parse_payload, peek, to_payload
from shoplake.functions.values import cents_lost
from shoplake.operators.events import product_ids, shape_events

@pytest.fixture
def products(spark):
    return product_ids(spark.createDataFrame([(1,), (2,), (2,), (None,)], "product_id int"))


def activity_of(spark, *values):
    when = dt.datetime(2024, 5, 6, 7, 8, 9, 10)
    data = [
        (10 * n + i, kind, 42, when, value, n)
        for n, value in enumerate(values)
        for i, kind in enumerate([*S.EVENT_TYPES, None])
    ]
    return spark.createDataFrame(
        data,
        "event_id bigint, event_type string, user_id bigint, ts timestamp_ntz, value double, product_id int",
    )


@pytest.fixture
def activity(spark):
    return activity_of(spark, 12.345, 12.345, 12.345, 12.345)


def test_every_value_comes_from_the_row(activity, products):
    events = shape_events(activity, products)
    assert events.schema.names == S.EVENT_SCHEMA.names
    assert [f.dataType for f in events.schema] == [f.dataType for f in S.EVENT_SCHEMA]
    for e in events.collect():
        n = int(e.event_id) // 10
        filled = {k: v for k, v in e.asDict().items() if v is not None}
        want = {"event_id": e.event_id, "user_id": "user_42", "timestamp": "2024-05-06T07:08:09.000010"}
        if e.event_type:
            want["event_type"] = e.event_type
        if e.event_type not in (None, S.PRODUCT_SEARCH) and n in (1, 2):
            want["product_id"] = str(n)
        if e.event_type == S.CHECKOUT:
            want["cart_value_cents"] = 1235
        if e.event_type == S.PURCHASE:
            want["purchase_value_cents"] = 1235
        assert filled == want


def test_a_value_without_room_is_null_and_told(spark, products):
    values = (3e7, 1e17, float("nan"), float("inf"), None, -0.005, 21474836.47)
    activity = activity_of(spark, *values)
    shaped = {int(e.event_id) // 10: e for e in shape_events(activity, products).collect()
              if e.event_type == S.PURCHASE}
    cents_of = [shaped[n].purchase_value_cents for n in range(len(values))]
    assert cents_of == [None, None, None, None, None, -1, 2147483647]
    lost = activity.where(cents_lost("value")).select("value").distinct().count()
    assert lost == 4


def test_payload_round_trip(activity, products):
    events = shape_events(activity, products)
    back = parse_payload(to_payload(events)).drop(S.CORRUPT_RECORD)
    assert rows(back) == rows(events)
    pretty = to_payload(events, pretty=True)
    assert "\n" in pretty.first().value
    assert peek(events).count() == 3
    assert rows(parse_payload(pretty).drop(S.CORRUPT_RECORD)) == rows(events)


def test_rejects_are_texts_without_any_field(spark):
    texts = ['{"event_id":"1"}', "not json", '{"event_id":2}', '{"event_id":"3","quantity":"x"}',
             '{"other":1}', "{}"]
    parsed = parse_payload(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r._corrupt_record for r in parsed.where(is_reject()).collect()] == ["not json"]
    kept = parsed.where(~is_reject())
    assert rows(kept.select("event_id")) == [("1",), ("2",), ("3",), (None,), (None,)]


def test_attributes_pass_under_their_own_type(spark, activity, products):
    from pyspark.sql import functions as F

    given = {
        "session_id": "s9", "view_duration_seconds": "30", "quantity": "3", "items_count": "4",
        "payment_method": "paypal", "search_query": "phone",
    }
    more = activity.withColumns({name: F.lit(value) for name, value in given.items()})
    own = {
        S.PRODUCT_VIEW: {"view_duration_seconds": 30}, S.ADD_TO_CART: {"quantity": 3},
        S.CHECKOUT: {"items_count": 4}, S.PURCHASE: {"payment_method": "paypal"},
        S.PRODUCT_SEARCH: {"search_query": "phone"}, None: {},
    }
    for e in shape_events(more, products).collect():
        filled = {k: v for k, v in e.asDict().items() if k in given and v is not None}
        assert filled == {"session_id": "s9", **own[e.event_type]}
    odd = activity.withColumns({"quantity": F.lit("many"), "items_count": F.lit(1 << 40)})
    shaped = shape_events(odd, products)
    assert [f.dataType for f in shaped.schema] == [f.dataType for f in S.EVENT_SCHEMA]
    assert shaped.where("quantity IS NOT NULL OR items_count IS NOT NULL").isEmpty()


def per_task(df):
    """Rows that each task gives."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def numbered(spark, n):
    """Events in four tasks; each number is there twice. Spark does not know beforehand how many there are."""
    ids = spark.range(0, n // 2, 1, 4).select(F.explode(F.array("id", "id")).alias("event_id"))
    return ids.select(F.col("event_id").cast("string").alias("event_id"))


@pytest.mark.parametrize("n", [8000, 8001])
def test_a_peek_at_all_events_is_not_one_task(spark, n):
    events = numbered(spark, 8000)
    shown = peek(events, n)
    assert per_task(shown) == [2000] * 4
    assert rows(parse_payload(shown).select("event_id")) == rows(events)


@pytest.mark.parametrize("n", [1001, 5000, 7999])
def test_a_long_peek_is_cut_in_many_tasks(spark, n):
    events = numbered(spark, 8000)
    shown = peek(events, n)
    back = parse_payload(shown).select("event_id")
    assert back.count() == n
    assert back.exceptAll(events).count() == 0
    assert shown.where(~F.col("value").contains("\n")).count() == 0
    assert max(per_task(shown)) <= n // 4 + 200


def test_peeks_take_equal_events_too(spark, monkeypatch):
    monkeypatch.setattr(payload, "ONE_TASK_ROWS", 10)
    monkeypatch.setattr(payload, "COPIES_PER_TASK", 100)
    events = spark.range(0, 1000, 1, 4).select(F.lit("same").alias("event_id"))
    for n in (11, 990, 999):
        shown = peek(events, n)
        assert rows(parse_payload(shown).select("event_id")) == [("same",)] * n
    assert max(per_task(shown)) <= 200
    mixed = events.unionByName(spark.range(30).select(F.col("id").cast("string").alias("event_id")))
    for n in range(11, 1030, 170):
        back = parse_payload(peek(mixed, n)).select("event_id")
        assert back.count() == n
        assert back.exceptAll(mixed).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_short_peeks(spark, n):
    events = numbered(spark, 4000)
    assert peek(events, n).count() == n
    assert peek(events.limit(0), n).count() == 0
    assert peek(events.limit(0), n + 1001).count() == 0
