"""Batch queries over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.config import FACT_TABLE, LakeConfig, scratch_dir
from shoplake.functions import payload, temporal, values
from shoplake.operators import daily
from shoplake.operators.events import product_ids, shape_events
from shoplake.operators.facts import join_order_items
from shoplake.plans.daily_metrics import (
    APPEND,
    all_daily_metrics,
    daily_metrics,
    latest_daily_metrics,
    publish_all_days,
    publish_daily_metrics,
)
from shoplake.plans.fact_orders import build_fact_orders
from shoplake.plans.ingest import ingest_all, ingest_csv
from shoplake.plans.profile import count_tables, profile_database
from shoplake.sinks import files as sink
from shoplake.sinks.catalog import create_database, describe_tables, list_tables, register_external
from shoplake.sinks.snapshots import replace_table
from shoplake.sources.csv_files import discover_csv, scan_csv
from shoplake.sources.files import landing_head, landing_summary
from shoplake.sources.tables import scan_table
from workload import tables as given_tables
from workload.oracle import ORDERS_ON
from workload.tables import BATCH_TABLES, fresh_config, given, given_path

LANDED_PARTS = 25


def plain(df: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles, for comparison between engines."""
    shown = {"timestamp_ntz": temporal.iso_text, "timestamp": temporal.iso_text}
    columns = []
    for name, kind in df.dtypes:
        if kind in shown:
            columns.append(shown[kind](name).alias(name))
        elif kind.startswith("decimal"):
            columns.append(F.col(name).cast("double").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


# -- sources -----------------------------------------------------------------------------


def types_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = given(spark, sf_dir, "orders"), scratch_dir(spark, "csv") + "/orders.csv"
    sink.land_csv(orders, path)
    return plain(scan_csv(spark, path, types_of(orders)))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv") + "/supplier.csv"
    sink.land_csv(given(spark, sf_dir, "supplier"), path)
    scanned = scan_csv(spark, path)
    return scanned.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


def csv_scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = given(spark, sf_dir, "documents")
    path = scratch_dir(spark, "csv") + "/documents.csv"
    quoting = {"escape": '"', "lineSep": "\n", "maxCharsPerColumn": "-1"}
    quoting |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    sink.land_csv(texts, path, quoteAll="true", **quoting)
    return scan_csv(spark, path, types_of(texts), multi_line=True, **quoting)


def land_all(spark: SparkSession, sf_dir: str, cfg: LakeConfig) -> LakeConfig:
    for name in BATCH_TABLES:
        sink.land_csv(given(spark, sf_dir, name), cfg.raw(f"{name}.csv"))
    return cfg


def raw_config(spark: SparkSession, sf_dir: str, label: str) -> LakeConfig:
    types: dict[str, str] = {}
    for name in BATCH_TABLES:
        types |= types_of(given(spark, sf_dir, name))
    return fresh_config(spark, label, column_types=types)


def discover_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = land_all(spark, sf_dir, raw_config(spark, sf_dir, "discover"))
    found = discover_csv(spark, cfg.raw())
    counts = count_tables(
        spark, {t: scan_csv(spark, cfg.raw(f"{t}.csv"), cfg.column_types) for t in BATCH_TABLES}
    )
    return found.join(counts, "table_name").select(
        "file_name", "table_name", F.col("count").alias("n_rows")
    )


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = registered(spark, sf_dir, "scan", ["orders"])
    return plain(scan_table(spark, cfg.table("orders")))


def landed_events(spark: SparkSession, sf_dir: str, path: str) -> str:
    """All shaped events as JSON lines in 25 files."""
    shape_events_query(spark, sf_dir).repartition(LANDED_PARTS).write.json(path)
    return path


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed event, with the number of files and whether the listed bytes are those of the lines."""
    path = landed_events(spark, sf_dir, scratch_dir(spark, "landing") + "/events")
    lines = spark.read.text(path)
    n_bytes = lines.agg(F.sum(F.octet_length("value") + 1)).scalar()
    summary = landing_summary(spark, path, "*.json")
    return payload.parse_payload(lines).select(
        "event_id",
        "event_type",
        summary.select("n_files").scalar().alias("n_files"),
        (summary.select("n_bytes").scalar() == n_bytes).alias("all_bytes"),
    )


def landing_head_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed event, and how many of the files are shown."""
    path = landed_events(spark, sf_dir, scratch_dir(spark, "landing") + "/events")
    shown = landing_head(spark, path, 5, "*.json").where("size > 0").agg(F.count("name").alias("n"))
    events = payload.parse_payload(spark.read.text(path))
    return events.select("event_id", "user_id", shown.scalar().alias("n_shown"))


def peek_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many events as there are, as indented JSON, read back."""
    events = shape_events_query(spark, sf_dir)
    shown = payload.peek(events, events.count())
    back = payload.parse_payload(shown).drop(payload.CORRUPT_RECORD)
    return back.withColumn("indented", shown.where(~F.col("value").contains("\n")).count() == F.lit(0))


# -- sinks and catalog -------------------------------------------------------------------


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder is overwritten, then a table twice by snapshots, the second time from its own rows."""
    path = scratch_dir(spark, "overwrite") + "/customer"
    for _ in range(2):
        sink.overwrite(given(spark, sf_dir, "customer"), path)
    cfg = fresh_config(spark, "overwrite")
    create_database(spark, cfg.database, cfg.database_folder())
    name, place = cfg.table("customer"), cfg.processed("customer")
    replace_table(spark.read.parquet(path), name, place)
    return replace_table(spark.table(name), name, place)


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "append") + "/customer"
    for _ in range(2):
        sink.append(given(spark, sf_dir, "customer"), path)
    return spark.read.parquet(path)


def registered(spark: SparkSession, sf_dir: str, label: str, names: list[str]) -> LakeConfig:
    """A database whose tables lie over the given files."""
    cfg = fresh_config(spark, label)
    create_database(spark, cfg.database, cfg.database_folder())
    for name in names:
        register_external(spark, cfg.table(name), given_path(sf_dir, name))
    return cfg


def register_external_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered twice, the second time over another table's files."""
    cfg = registered(spark, sf_dir, "register", ["customer"])
    register_external(spark, cfg.table("customer"), given_path(sf_dir, "supplier"))
    return spark.table(cfg.table("customer"))


def ingest_csv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = raw_config(spark, sf_dir, "ingest")
    sink.land_csv(given(spark, sf_dir, "customer"), cfg.raw("customer.csv"))
    return ingest_csv(spark, "customer.csv", cfg)


def ingest_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = land_all(spark, sf_dir, raw_config(spark, sf_dir, "ingest-all"))
    loaded = ingest_all(spark, cfg)
    counts = count_tables(spark, loaded).withColumnRenamed("count", "n_rows")
    ids = loaded["lineitem"].select(F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("n_rows"))
    return counts.unionByName(ids)


def list_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table names, each with its number of rows."""
    cfg = registered(spark, sf_dir, "list", BATCH_TABLES)
    names = list_tables(spark, cfg.database)
    return names.join(profile_database(spark, cfg.database).counts, "table_name").withColumnRenamed(
        "count", "n_rows"
    )


def describe_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the tables, each with its number of values."""
    cfg = registered(spark, sf_dir, "describe", BATCH_TABLES)
    counts = []
    for name in BATCH_TABLES:
        table = spark.table(cfg.table(name))
        row = table.agg(*[F.count(c).alias(c) for c in table.columns])
        counts.append(
            row.unpivot([], table.columns, "column_name", "n_values").withColumn("table_name", F.lit(name))
        )
    values = reduce(DataFrame.unionByName, counts)
    return describe_tables(spark, cfg.database).join(values, ["table_name", "column_name"])


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = registered(spark, sf_dir, "counts", BATCH_TABLES)
    return profile_database(spark, cfg.database).counts.withColumnRenamed("count", "n_rows")


def sample_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a sample has, and how many of those are rows of the table."""
    cfg = registered(spark, sf_dir, "sample", BATCH_TABLES)
    samples = profile_database(spark, cfg.database).samples
    known = {t: s.intersect(spark.table(cfg.table(t))) for t, s in samples.items()}
    sampled = count_tables(spark, samples).withColumnRenamed("count", "n_sampled")
    return sampled.join(count_tables(spark, known).withColumnRenamed("count", "n_known"), "table_name")


# -- facts and metrics -------------------------------------------------------------------


def facts_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_order_items(
        given_tables.shop_orders(spark, sf_dir), given_tables.shop_items(spark, sf_dir)
    )


def stored_facts(spark: SparkSession, sf_dir: str, label: str = "facts", **settings) -> LakeConfig:
    cfg = fresh_config(spark, label, **settings)
    build_fact_orders(
        spark,
        cfg,
        given_tables.shop_orders(spark, sf_dir),
        given_tables.shop_items(spark, sf_dir),
    )
    return cfg


def fact_table(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    return spark.table(cfg.table(FACT_TABLE))


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fact_table(spark, stored_facts(spark, sf_dir)))


def fact_orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact_table(spark, stored_facts(spark, sf_dir, fact_by_month=True))
    return plain(facts)


def daily_order_metrics_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_metrics(fact_table(spark, stored_facts(spark, sf_dir, fact_by_month=True)))


def orders_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_date = daily.facts_on_date(facts_inline(spark, sf_dir), ORDERS_ON)
    return plain(on_date.select("order_id", "customer_id", "seller_id", "product_id", "price"))


def orders_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.orders_per_day(fact_table(spark, stored_facts(spark, sf_dir)))


def latest_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.latest_order_date(facts_inline(spark, sf_dir))


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's distinct counts, day by day."""
    per_day = daily.metrics_per_day(facts_inline(spark, sf_dir))
    return per_day.select("order_date", *daily.DISTINCT_COUNTS)


def sales_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's sums and mean, day by day."""
    per_day = daily.metrics_per_day(facts_inline(spark, sf_dir))
    return per_day.select("order_date", "total_sales", "total_shipping", "avg_order_value")


def daily_order_metrics_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_daily_metrics(spark, stored_facts(spark, sf_dir))


def daily_order_metrics_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_metrics(facts_inline(spark, sf_dir), ORDERS_ON)


def daily_order_metrics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_daily_metrics(spark, stored_facts(spark, sf_dir))


def daily_order_metrics_publish_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_all_days(spark, stored_facts(spark, sf_dir, "publish_all"))


def daily_order_metrics_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = stored_facts(spark, sf_dir, "rerun")
    for _ in range(2):
        published = publish_daily_metrics(spark, cfg)
    return published


def daily_order_metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = stored_facts(spark, sf_dir, "append")
    for _ in range(2):
        published = publish_daily_metrics(spark, cfg, write_mode=APPEND)
    return published


# -- scalar functions --------------------------------------------------------------------


def scalar_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = temporal.day_of("o_orderdate").alias("order_date")
    return given(spark, sf_dir, "orders").select("o_orderkey", day)


def scalar_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = temporal.date_text(temporal.day_of("o_orderdate")).alias("date_text")
    return given(spark, sf_dir, "orders").select("o_orderkey", text)


def scalar_iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select("event_id", temporal.iso_text("ts").alias("iso"))


def scalar_prefixed_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lit(1000) + F.col("user_id")
    return given(spark, sf_dir, "events").select(
        "event_id", values.prefixed("user_", number).alias("id")
    )


def scalar_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select("event_id", values.cents("value").alias("cents"))


def event_ids_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new unique id beside each event's own."""
    ids = given(spark, sf_dir, "events").select("event_id", F.uuid().alias("id"))
    return ids.agg(
        F.count("event_id").alias("n_events"),
        F.count_distinct("id").alias("n_ids"),
        F.max(F.length("id")).alias("id_length"),
    )


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select(
        "event_id", payload.json_int("props", "k").alias("k")
    )


def utf8_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given(spark, sf_dir, "documents").select("doc_id", values.utf8_bytes("text").alias("raw"))
    return raw.select(
        "doc_id",
        values.utf8_text("raw").alias("text"),
        F.octet_length("raw").cast("bigint").alias("n_bytes"),
    )


# -- events ------------------------------------------------------------------------------


def shop_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_ids(given_tables.shop_products(spark, sf_dir))


def shape_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = given_tables.shop_activity(given(spark, sf_dir, "events"))
    return shape_events(activity, shop_pool(spark, sf_dir))


def events_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = payload.parse_payload(payload.to_payload(shape_events_query(spark, sf_dir)))
    return parsed.drop(payload.CORRUPT_RECORD)


BATCH_QUERIES = {
    "csv_scan": csv_scan,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_scan_multiline": csv_scan_multiline,
    "discover_raw": discover_raw,
    "table_scan": table_scan,
    "landing_files": landing_files,
    "landing_head": landing_head_query,
    "sink_overwrite": sink_overwrite,
    "sink_append": sink_append,
    "register_external": register_external_query,
    "ingest_csv": ingest_csv_query,
    "ingest_all": ingest_all_query,
    "list_tables": list_tables_query,
    "describe_tables": describe_tables_query,
    "table_counts": table_counts,
    "sample_rows": sample_rows_query,
    "fact_orders": fact_orders,
    "fact_orders_by_month": fact_orders_by_month,
    "orders_on_date": orders_on_date,
    "orders_per_day": orders_per_day,
    "latest_order_date": latest_order_date,
    "distinct_counts": distinct_counts,
    "sales_sums": sales_sums,
    "daily_order_metrics_latest": daily_order_metrics_latest,
    "daily_order_metrics_date": daily_order_metrics_date,
    "daily_order_metrics_all": daily_order_metrics_all,
    "daily_order_metrics_rerun": daily_order_metrics_rerun,
    "daily_order_metrics_publish_all": daily_order_metrics_publish_all,
    "daily_order_metrics_append": daily_order_metrics_append,
    "daily_order_metrics_by_month": daily_order_metrics_by_month,
    "scalar_date": scalar_date,
    "scalar_date_text": scalar_date_text,
    "scalar_iso_text": scalar_iso_text,
    "scalar_prefixed_id": scalar_prefixed_id,
    "scalar_cents": scalar_cents,
    "event_ids_unique": event_ids_unique,
    "json_parse": json_parse,
    "utf8_roundtrip": utf8_roundtrip,
    "product_pool": shop_pool,
    "peek_events": peek_events,
    "shape_events": shape_events_query,
    "events_to_json": events_to_json,
}
