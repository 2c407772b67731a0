"""From landed event files to the raw events table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from shoplake.config import EVENT_ARCHIVE, EVENT_LANDING, RAW_EVENTS_TABLE, LakeConfig
from shoplake.functions.payload import is_reject
from shoplake.schemas import CORRUPT_RECORD, EVENT_SCHEMA, PROCESSING_TIME, raw_events_schema
from shoplake.sinks.batches import READ_OPTIONS, refuse_file_sink, write_batch
from shoplake.sinks.catalog import create_database, register_external
from shoplake.sources.events import read_landing, skipped_files
from shoplake.sources.files import make_folder
from shoplake.streaming.runs import REPORT_SCHEMA, RunLog, outcome, run_bounded, triggered

REJECTS = "rejected_events"
REPORT = "ingest_report"
RUN = "run_id"
STORED_REPORT = f"{REPORT_SCHEMA}, {RUN} string"


@dataclass(frozen=True)
class IngestRun:
    table: DataFrame
    report: DataFrame
    skipped: DataFrame
    outcome: str
    ended: bool
    caught_up: bool


def start_raw_events(
    spark: SparkSession,
    cfg: LakeConfig,
    schema: T.StructType = EVENT_SCHEMA,
    bytes_per_batch: int | None = None,
    available_now: bool = True,
    keep_rejects: bool = True,
    run_id: str | None = None,
) -> StreamingQuery:
    """Append landed events, with the time of processing, to the raw events files, and lines of which nothing could
    be read, whole, to the rejects files.

    Each batch is read once; its events, its rejects and its line of the report are written under the number
    of the batch (``write_batch``), so a batch that is run again adds nothing twice, and the
    report knows every batch that was written. Rows with an unreadable field are kept without that field.
    """
    paths = {name: cfg.processed(name) for name in (RAW_EVENTS_TABLE, REJECTS, REPORT)}
    for path in paths.values():
        make_folder(spark, path)
        refuse_file_sink(spark, path)
    archive = cfg.temp(EVENT_ARCHIVE) if cfg.archive_landed else None
    landed = read_landing(
        spark, cfg.temp(EVENT_LANDING), schema, cfg.files_per_batch, bytes_per_batch, archive
    )
    stamped = landed.withColumn(PROCESSING_TIME, F.current_timestamp())
    name = f"{cfg.database}.{RAW_EVENTS_TABLE}"
    run_id = run_id or uuid.uuid4().hex
    unclean, rejected = F.col(CORRUPT_RECORD).isNotNull(), is_reject(schema)

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.persist()  # read once, for the counts and for what is written
        try:
            n, partial, bad = rows.agg(
                F.count(F.lit(1)), F.count_if(unclean & ~rejected), F.count_if(rejected)
            ).first()
            if n > bad:
                write_batch(rows.where(~rejected).drop(CORRUPT_RECORD), paths[RAW_EVENTS_TABLE], number, cfg.fmt)
            if bad and keep_rejects:
                lines = rows.where(rejected).select(F.col(CORRUPT_RECORD).alias("line"), PROCESSING_TIME)
                write_batch(lines, paths[REJECTS], number, cfg.fmt)
            if n:
                line = batch.sparkSession.createDataFrame([(name, number, n, partial, bad, run_id)], STORED_REPORT)
                write_batch(line.coalesce(1), paths[REPORT], number, cfg.fmt)
        finally:
            rows.unpersist()

    writer = (
        stamped.writeStream.foreachBatch(write)
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", cfg.checkpoint(RAW_EVENTS_TABLE))
    )
    return triggered(writer, available_now).start()


def register_raw_events(
    spark: SparkSession, cfg: LakeConfig, schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """The raw events table; it may be registered before the first batch has landed.

    Columns that an earlier run's schema had and ``schema`` has not stay in the table.
    """
    create_database(spark, cfg.database, cfg.database_folder())
    name = cfg.table(RAW_EVENTS_TABLE)
    known = {*schema.names, PROCESSING_TIME}
    earlier = spark.table(name).schema if spark.catalog.tableExists(name) else T.StructType()
    schema = T.StructType([*schema, *[field for field in earlier if field.name not in known]])
    return register_external(
        spark,
        name,
        cfg.processed(RAW_EVENTS_TABLE),
        cfg.fmt,
        schema=raw_events_schema(schema),
        **READ_OPTIONS,
    )


def rejected_events(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Lines of which nothing could be read, with the time of processing."""
    return _stored(spark, cfg, REJECTS, f"line string, {PROCESSING_TIME} timestamp")


def ingest_report(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """A row for every batch of all runs, also those that were killed: its rows, and how many of them were not clean."""
    return _stored(spark, cfg, REPORT, STORED_REPORT)


def _stored(spark: SparkSession, cfg: LakeConfig, table: str, schema: str) -> DataFrame:
    path = cfg.processed(table)
    make_folder(spark, path)
    return spark.read.format(cfg.fmt).options(**READ_OPTIONS).schema(schema).load(path)


def ingest_event_stream(
    spark: SparkSession,
    cfg: LakeConfig,
    schema: T.StructType = EVENT_SCHEMA,
    budget_seconds: float | None = None,
    available_now: bool = True,
    keep_rejects: bool = True,
    bytes_per_batch: int | None = None,
) -> IngestRun:
    """Ingest landed events until none are left, or the budget (if any) is spent, then report.

    The outcome of a run cut short is INCOMPLETE; started again it goes on where it stopped. The report has the batches
    of this run; ``ingest_report`` has those of all.
    """
    log, run_id = RunLog(), uuid.uuid4().hex
    query = start_raw_events(spark, cfg, schema, bytes_per_batch, available_now, keep_rejects, run_id)
    ended = run_bounded([query], budget_seconds, log)
    report = ingest_report(spark, cfg).where(F.col(RUN) == run_id).drop(RUN)
    return IngestRun(
        register_raw_events(spark, cfg, schema),
        report,
        skipped_files(spark, cfg.temp(EVENT_LANDING)),
        outcome(report, ended),
        ended,
        log.caught_up,
    )
