"""Streaming queries over the given events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.config import BRIDGED, EVENT_LANDING, LakeConfig
from shoplake.functions.payload import parse_payload, to_payload
from shoplake.operators.events import shape_events
from shoplake.schemas import CORRUPT_RECORD, EVENT_SCHEMA
from shoplake.sinks.files import append
from shoplake.sources.events import read_bus, read_table_files
from shoplake.streaming.bridge import start_bridge
from shoplake.streaming.raw_events import ingest_event_stream, rejected_events
from shoplake.streaming.runs import run_bounded
from workload.batch import landed_events, shape_events_query, shop_pool
from workload.tables import fresh_config, given, shop_activity


def given_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table as a stream of files."""
    schema = given(spark, sf_dir, name).schema
    return read_table_files(spark, sf_dir, schema, pathGlobFilter=f"{name}.parquet")


def shaped_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = shop_activity(given_stream(spark, sf_dir, "events"))
    return shape_events(activity, shop_pool(spark, sf_dir))


def bridged(spark: SparkSession, cfg: LakeConfig, bodies: DataFrame) -> None:
    run_bounded([start_bridge(bodies, cfg)])


def ingested(spark: SparkSession, cfg: LakeConfig, schema: T.StructType = EVENT_SCHEMA, **kw):
    return ingest_event_stream(spark, cfg, schema, **kw)


def landed_text(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    return spark.read.text(cfg.temp(EVENT_LANDING, BRIDGED))


def bridge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = fresh_config(spark, "bridge")
    bridged(spark, cfg, to_payload(shaped_stream(spark, sf_dir)))
    return parse_payload(landed_text(spark, cfg)).drop(CORRUPT_RECORD)


def stream_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = fresh_config(spark, "ingest")
    bridged(spark, cfg, to_payload(shaped_stream(spark, sf_dir)))
    raw = ingested(spark, cfg).table
    return raw.withColumn("has_processing_time", F.col("processing_time").isNotNull()).drop(
        "processing_time"
    )


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ingested event, and what the report says of the batches."""
    cfg = fresh_config(spark, "batches")
    landed_events(spark, sf_dir, cfg.temp(EVENT_LANDING))
    run = ingested(spark, cfg)
    told = run.report.agg(
        F.count("batch_id").alias("n_batches"), F.sum("num_input_rows").alias("n_input_rows")
    )
    return run.table.select(
        "event_id",
        told.select("n_batches").scalar().alias("n_batches"),
        told.select("n_input_rows").scalar().alias("n_input_rows"),
        F.lit(run.outcome).alias("outcome"),
    )


def stream_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies from a message source into the landing; Kafka's place is taken by a file source."""
    cfg = fresh_config(spark, "bus")
    append(to_payload(shape_events_query(spark, sf_dir)), cfg.temp("bus"))
    bridged(spark, cfg, read_bus(spark, "parquet", path=cfg.temp("bus"), schema="value string"))
    return parse_payload(landed_text(spark, cfg)).drop(CORRUPT_RECORD)


def stream_landed_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases come over the bridge, all others from a producer that writes compressed files."""
    cfg = fresh_config(spark, "two")
    purchase = F.col("event_type") == "purchase"
    bridged(spark, cfg, to_payload(shaped_stream(spark, sf_dir).where(purchase)))
    others = to_payload(shape_events_query(spark, sf_dir).where(~purchase))
    others.write.mode("append").option("compression", "gzip").text(cfg.temp("made"))
    take_over(spark, cfg.temp("made"), cfg.temp(EVENT_LANDING))
    return ingested(spark, cfg).table.drop("processing_time")


def take_over(spark: SparkSession, source: str, target: str) -> None:
    """Put the files of another producer into the landing folder, as .json.gz."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, file in enumerate(fs.globStatus(path(f"{source}/part-*"))):
        fs.rename(file.getPath(), path(f"{target}/other_{i}.json.gz"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = fresh_config(spark, "restart")
    bodies = to_payload(shaped_stream(spark, sf_dir))
    for _ in range(2):
        bridged(spark, cfg, bodies)
        raw = ingested(spark, cfg).table
    return raw.drop("processing_time")


def stream_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events arrive twice; the second time the schema has one more column."""
    cfg = fresh_config(spark, "evolution")
    bus = cfg.temp("bus")
    payloads = to_payload(shape_events_query(spark, sf_dir))
    first = T.StructType([EVENT_SCHEMA["event_id"]])
    second = T.StructType([EVENT_SCHEMA["event_id"], EVENT_SCHEMA["product_id"]])
    for schema in (first, second):
        append(payloads, bus)
        bridged(spark, cfg, read_table_files(spark, bus, payloads.schema))
        raw = ingested(spark, cfg, schema, keep_rejects=False).table
    return raw.drop("processing_time")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events arrive as text that is not JSON, clicks with a wrong-typed field."""
    cfg = fresh_config(spark, "rejects")
    events = given_stream(spark, sf_dir, "events")
    kind = F.col("event_type")
    quantity = F.when(kind == "click", F.lit('"many"')).otherwise(F.lit("1"))
    record = F.format_string(
        '{"event_id":"%d","event_type":"%s","quantity":%s}', "event_id", kind, quantity
    )
    sent = F.when(kind == "error", F.concat(F.lit("cut off: "), record)).otherwise(record)
    bridged(spark, cfg, events.select(sent.alias("value")))
    run = ingested(spark, cfg)
    rejected = rejected_events(spark, cfg)

    def counted(kind: str, n: Column, rows: DataFrame) -> DataFrame:
        return rows.agg(n.alias("n")).select(F.lit(kind).alias("kind"), "n")

    no_quantity = F.count_if(F.col("quantity").isNull())
    return (
        counted("kept", F.count(F.lit(1)), run.table)
        .unionByName(counted("rejected", F.count("line"), rejected))
        .unionByName(counted("no_quantity", no_quantity, run.table))
        .unionByName(counted("reported_rejected", F.sum("rejected_rows"), run.report))
        .unionByName(counted("reported_partial", F.sum("partial_rows"), run.report))
    )


STREAM_QUERIES = {
    "bridge_events": bridge_events,
    "stream_json_ingest": stream_json_ingest,
    "stream_batches": stream_batches,
    "stream_restart": stream_restart,
    "stream_schema_evolution": stream_schema_evolution,
    "stream_rejects": stream_rejects,
    "stream_bus": stream_bus,
    "stream_landed_by_two": stream_landed_by_two,
}
