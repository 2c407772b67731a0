"""The jobs as commands: ``spark-submit`` this package's folder, or ``python -m shoplake``.

    ingest    load every CSV entry of the raw zone
    profile   columns and row counts of all tables
    facts     rebuild the order facts
    metrics   publish the metrics of a day (the newest without --date)
    bridge    land message bodies of a stream as event files
    events    ingest landed events into the raw events table
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from shoplake.config import DATABASE, FILES_PER_BATCH, LakeConfig
from shoplake.plans.daily_metrics import APPEND, REPLACE_DATE, publish_daily_metrics
from shoplake.plans.fact_orders import build_fact_orders
from shoplake.plans.ingest import ingest_all
from shoplake.plans.profile import profile_database
from shoplake.sources.events import read_bus
from shoplake.streaming.bridge import start_bridge
from shoplake.streaming.raw_events import ingest_event_stream
from shoplake.streaming.runs import RunLog, outcome, run_bounded


def ingest(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace) -> None:
    for name in ingest_all(spark, cfg):
        print(f"loaded {cfg.database}.{name}")


def profile(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace) -> None:
    found = profile_database(spark, cfg.database)
    found.columns.show(found.columns.count(), truncate=False)
    found.counts.show(found.counts.count(), truncate=False)
    for name, sample in found.samples.items():
        print(name)
        sample.show()


def facts(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace) -> None:
    build_fact_orders(spark, cfg)


def metrics(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace) -> None:
    publish_daily_metrics(spark, cfg, args.date, args.write_mode).show()


def bridge(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace) -> None:
    options = dict(pair.split("=", 1) for pair in args.option)
    bodies = read_bus(spark, args.source, **options)
    query = start_bridge(bodies, cfg, available_now=not args.keep_running)
    log = RunLog()
    ended = run_bounded([query], args.seconds, log)
    report = log.report(spark)
    report.show(report.count())
    print(outcome(report, ended or args.keep_running and log.caught_up))


def events(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace) -> None:
    run = ingest_event_stream(
        spark,
        cfg,
        budget_seconds=args.seconds,
        available_now=not args.keep_running,
        bytes_per_batch=args.bytes_per_batch,
    )
    run.report.show(run.report.count())
    skipped = run.skipped.count()
    if skipped:
        print(f"{skipped} files that are no event files were not read")
    print(outcome(run.report, run.ended or args.keep_running and run.caught_up))


COMMANDS = {
    "ingest": ingest,
    "profile": profile,
    "facts": facts,
    "metrics": metrics,
    "bridge": bridge,
    "events": events,
}


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        "shoplake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--root", required=True, help="folder of the zones")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--orders-table", default="orders")
    parser.add_argument("--items-table", default="order_items")
    parser.add_argument("--products-table", default="products")
    parser.add_argument("--by-month", action="store_true", help="partition the facts by month")
    parser.add_argument("--date", help="day as YYYY-MM-DD")
    parser.add_argument("--write-mode", default=REPLACE_DATE, choices=[REPLACE_DATE, APPEND])
    parser.add_argument("--source", default="kafka", help="format of the message source")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--seconds", type=float, help="stop a streaming run after this time; by default it ends when all is read")
    parser.add_argument("--keep-running", action="store_true", help="run on until the budget ends")
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH)
    parser.add_argument("--bytes-per-batch", type=int)
    parser.add_argument("--archive-landed", action="store_true", help="move event files away that were read")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    cfg = LakeConfig(
        root=args.root,
        database=args.database,
        fmt=args.format,
        orders_table=args.orders_table,
        items_table=args.items_table,
        products_table=args.products_table,
        fact_by_month=args.by_month,
        files_per_batch=args.files_per_batch,
        archive_landed=args.archive_landed,
    )
    COMMANDS[args.command](spark or SparkSession.builder.getOrCreate(), cfg, args)


if __name__ == "__main__":
    main()
