"""Bridge, ingest, restart, rejects and reports."""

from __future__ import annotations

import dataclasses
import gzip
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import types as T

from shoplake.config import BRIDGED, EVENT_LANDING
from shoplake.functions.payload import parse_payload
from shoplake.schemas import CORRUPT_RECORD, EVENT_SCHEMA
from shoplake.sources.events import read_bus, read_event_files, read_table_files
from shoplake.streaming.bridge import start_bridge
from shoplake.streaming.raw_events import (
    ingest_event_stream,
    ingest_report,
    register_raw_events,
    rejected_events,
    start_raw_events,
)
from shoplake.sinks import batches
from shoplake.streaming import raw_events, runs
from shoplake.streaming.runs import RunLog, outcome, run_bounded


def land(cfg, **files: str) -> None:
    folder = Path(cfg.temp(EVENT_LANDING))
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)


def event(i: int, **more) -> str:
    return json.dumps({"event_id": str(i), "event_type": "add_to_cart", "quantity": 1, **more})


@pytest.fixture
def landed(cfg):
    land(cfg, **{f"events_{i}__json": event(i, extra="x") for i in range(23)})
    land(
        cfg,
        events_bad__json=event(23, quantity="notint"),
        events_pretty__json='{\n"event_id": "24",\n"quantity": 1\n}',
        bridge_complete_1__txt="done",
    )
    return cfg


def test_batches_of_ten_files(spark, cfg):
    land(cfg, **{f"events_{i}__json": event(i) for i in range(25)})
    run = ingest_event_stream(spark, cfg)
    batches = run.report.orderBy("batch_id").collect()
    assert [(b.batch_id, b.num_input_rows) for b in batches] == [(0, 10), (1, 10), (2, 5)]
    assert run.outcome == "SUCCESS" and run.ended


def test_bytes_per_batch(spark, cfg):
    land(cfg, **{f"events_{i}__json": event(i) for i in range(25)})
    run = ingest_event_stream(spark, cfg, bytes_per_batch=1 << 30)
    assert [b.num_input_rows for b in run.report.collect()] == [25]


def test_awkward_files(spark, landed):
    run = ingest_event_stream(spark, landed)
    raw = run.table
    assert raw.columns == [*EVENT_SCHEMA.names, "processing_time"]
    assert sorted(int(r.event_id) for r in raw.collect()) == list(range(24))
    assert raw.where("event_id = '23'").first().quantity is None
    assert raw.where("processing_time IS NULL").count() == 0
    rejects = rejected_events(spark, landed)
    assert sorted(r.line for r in rejects.collect()) == sorted(
        ["{", '"event_id": "24",', '"quantity": 1', "}"]
    )
    totals = run.report.selectExpr(
        "sum(num_input_rows)", "sum(partial_rows)", "sum(rejected_rows)"
    ).first()
    assert tuple(totals) == (28, 1, 4)


def test_one_processing_time_per_batch(spark, cfg):
    land(cfg, **{f"events_{i}__json": event(i) for i in range(25)})
    raw = ingest_event_stream(spark, cfg).table
    assert raw.select("processing_time").distinct().count() == 3


def test_restart_reads_only_new_files(spark, landed):
    ingest_event_stream(spark, landed)
    again = ingest_event_stream(spark, landed)
    assert (again.table.count(), again.outcome) == (24, "WARNING")
    land(landed, events_new__json=event(99))
    more = ingest_event_stream(spark, landed)
    assert (more.table.count(), more.outcome) == (25, "SUCCESS")


def test_table_before_the_first_batch(spark, cfg):
    assert register_raw_events(spark, cfg).count() == 0
    land(cfg, events_1__json=event(1))
    assert ingest_event_stream(spark, cfg).table.count() == 1
    assert spark.table(cfg.table("raw_events")).count() == 1


def test_schema_grows_between_runs(spark, cfg):
    short = T.StructType([EVENT_SCHEMA["event_id"]])
    longer = T.StructType([EVENT_SCHEMA["event_id"], EVENT_SCHEMA["quantity"]])
    land(cfg, a__json='{"event_id":"1","quantity":5}')
    ingest_event_stream(spark, cfg, short, keep_rejects=False)
    land(cfg, b__json='{"event_id":"2","quantity":6}')
    run = ingest_event_stream(spark, cfg, longer, keep_rejects=False)
    assert rows(run.table.select("event_id", "quantity")) == [("1", None), ("2", 6)]
    land(cfg, c__json='{"event_id":"3","quantity":7}')
    run = ingest_event_stream(spark, cfg, short, keep_rejects=False)
    assert rows(run.table.select("event_id", "quantity")) == [("1", None), ("2", 6), ("3", None)]


def test_time_boxed_run_goes_on_later(spark, cfg):
    land(cfg, **{f"events_{i}__json": event(i) for i in range(25)})
    query = start_raw_events(spark, cfg, available_now=False)
    query.processAllAvailable()
    assert run_bounded([query], 0.2) is False
    assert not query.isActive
    land(cfg, late__json=event(25))
    assert ingest_event_stream(spark, cfg).table.count() == 26


def test_corrupt_lines(spark, cfg):
    land(cfg, a__json='{"event_id":"1"}\nnot json\n\n{"event_id":2}\n')
    stream = read_event_files(spark, cfg.temp(EVENT_LANDING))
    query = stream.writeStream.format("memory").queryName("corrupt").trigger(availableNow=True)
    run_bounded([query.start()], 60)
    found = spark.table("corrupt").select("event_id", CORRUPT_RECORD)
    assert rows(found) == [("1", None), ("2", None), (None, "not json")]


def bus(spark, cfg, bodies) -> str:
    path = cfg.temp("bus")
    frame = spark.createDataFrame([(b,) for b in bodies], "value string")
    frame.coalesce(1).write.mode("append").parquet(path)
    return path


def test_bridge_lands_bodies_whole_and_once(spark, cfg):
    bodies = [event(i, note="ü ö", unknown={"a": [1, 2]}) for i in range(7)]
    path = bus(spark, cfg, [*bodies, "not json", None])
    for _ in range(2):
        source = read_table_files(spark, path, T.StructType([T.StructField("value", T.StringType())]))
        run_bounded([start_bridge(source, cfg)], 60)
    landed = spark.read.text(cfg.temp(EVENT_LANDING, BRIDGED))
    assert sorted(r.value for r in landed.collect()) == sorted([*bodies, "not json"])


def test_blank_bodies_are_counted(spark, cfg):
    path = bus(spark, cfg, [event(1), None, "", " \r\n ", "not json"])
    source = read_table_files(spark, path, T.StructType([T.StructField("value", T.StringType())]))
    log = RunLog()
    assert run_bounded([start_bridge(source, cfg)], log=log)
    assert rows(log.report(spark).selectExpr("num_input_rows", "rejected_rows")) == [(5, 3)]
    assert spark.read.text(cfg.temp(EVENT_LANDING, BRIDGED)).count() == 2


def test_files_beside_a_bridge_are_read(spark, cfg):
    """The bridge's commit log must not hide what another producer lands."""
    path = bus(spark, cfg, [event(i) for i in range(3)])
    source = read_table_files(spark, path, T.StructType([T.StructField("value", T.StringType())]))
    run_bounded([start_bridge(source, cfg)], 60)
    land(cfg, events_foreign__json=event(3), more__jsonl=event(4) + "\n" + event(5), notes__md="x")
    Path(cfg.temp(EVENT_LANDING), "packed.json.gz").write_bytes(gzip.compress(event(6).encode()))
    run = ingest_event_stream(spark, cfg)
    assert sorted(int(r.event_id) for r in run.table.collect()) == list(range(7))
    assert rows(run.skipped) == [("notes.md",)]


def test_the_report_has_every_batch(spark, cfg):
    """Also those that Spark no longer remembers."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "10")
    try:
        land(cfg, **{f"events_{i}__json": event(i) for i in range(30)})
        one = dataclasses.replace(cfg, files_per_batch=1)
        run = ingest_event_stream(spark, one)
        assert [r.num_input_rows for r in run.report.collect()] == [1] * 30
    finally:
        spark.conf.set(kept, before)


def test_a_run_cut_short_says_so(spark, cfg):
    land(cfg, **{f"events_{i}__json": event(i) for i in range(60)})
    run = ingest_event_stream(spark, cfg, budget_seconds=0.01)
    assert (run.ended, run.outcome) == (False, "INCOMPLETE")
    again = ingest_event_stream(spark, cfg)
    assert (again.ended, again.outcome) == (True, "SUCCESS") or run.table.count() == 60
    assert again.table.count() == 60
    assert outcome(again.report.limit(0)) == runs.WARNING


def test_a_failed_query_raises(spark, cfg):
    land(cfg, a__json=event(1))
    stream = read_event_files(spark, cfg.temp(EVENT_LANDING))
    bad = stream.selectExpr("event_id", "raise_error('no')").writeStream.format("noop")
    query = bad.option("checkpointLocation", cfg.checkpoint("bad")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="no"):
        run_bounded([query])


def test_bridge_takes_binary_bodies_and_joins_lines(spark, cfg):
    pretty = json.dumps({"event_id": "1", "quantity": 2}, indent=2).replace("\n", "\r\n")
    path = bus(spark, cfg, [pretty])
    frame = read_table_files(spark, path, T.StructType([T.StructField("value", T.StringType())]))
    run_bounded([start_bridge(frame.selectExpr("CAST(value AS BINARY) AS value"), cfg)], 60)
    run = ingest_event_stream(spark, cfg)
    assert rows(run.table.select("event_id", "quantity")) == [("1", 2)]


def test_one_event_per_file(spark, cfg):
    path = bus(spark, cfg, [event(i) for i in range(25)])
    source = read_table_files(spark, path, T.StructType([T.StructField("value", T.StringType())]))
    run_bounded([start_bridge(source, cfg, one_event_per_file=True)], 60)
    run = ingest_event_stream(spark, cfg)
    batches = run.report.orderBy("batch_id").collect()
    assert [b.num_input_rows for b in batches] == [10, 10, 5]


def test_bus_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_bus(spark, subscribe="clicks")


def test_bus_source_reads_bodies(spark, cfg):
    stream = read_bus(spark, "rate", rowsPerSecond="1")
    assert stream.isStreaming and stream.dtypes == [("value", "string")]


def test_markers_do_not_matter_to_a_bridged_landing(spark, cfg):
    path = bus(spark, cfg, [event(1)])
    source = read_table_files(spark, path, T.StructType([T.StructField("value", T.StringType())]))
    run_bounded([start_bridge(source, cfg)], 60)
    land(cfg, processor_complete_1__txt="done")
    assert ingest_event_stream(spark, cfg).table.count() == 1


def test_other_format(spark, cfg):
    cfg = dataclasses.replace(cfg, fmt="orc")
    land(cfg, **{f"events_{i}__json": event(i) for i in range(3)})
    assert ingest_event_stream(spark, cfg).table.count() == 3


def test_missing_fields_are_null_and_unknown_ones_dropped(spark):
    frame = spark.createDataFrame([('{"event_id":"1","extra":1}',)], "value string")
    parsed = parse_payload(frame).first()
    assert parsed.event_id == "1" and parsed.quantity is None and parsed[CORRUPT_RECORD] is None


def test_files_in_the_making_are_not_read(spark, cfg):
    half = '{"event_id": "9", "quan'
    land(cfg, a__json=event(1), x__json__tmp=half, x__json___COPYING_=half, y__json__part=half, z__jsonl__gz__part=half)
    run = ingest_event_stream(spark, cfg)
    assert [r.event_id for r in run.table.collect()] == ["1"] and rejected_events(spark, cfg).isEmpty()
    # Spark itself lists no name that ends in ._COPYING_
    assert rows(run.skipped) == [("x.json.tmp",), ("y.json.part",), ("z.jsonl.gz.part",)]
    Path(cfg.temp(EVENT_LANDING), "x.json.tmp").rename(Path(cfg.temp(EVENT_LANDING), "x.json"))
    land(cfg, x__json=event(2))
    again = ingest_event_stream(spark, cfg)
    assert sorted(r.event_id for r in again.table.collect()) == ["1", "2"]


def test_read_files_are_archived(spark, cfg):
    cfg = dataclasses.replace(cfg, archive_landed=True)
    for k in range(3):  # a file is moved when the batch after its own is planned
        land(cfg, **{f"events_{k}__json": event(k)})
        run = ingest_event_stream(spark, cfg)
    assert run.table.count() == 3
    left = {p.name for p in Path(cfg.temp(EVENT_LANDING)).glob("*.json")}
    moved = {p.name for p in Path(cfg.temp("event-stream-archive")).rglob("*.json")}
    assert moved and left | moved == {f"events_{k}.json" for k in range(3)} and not left & moved


def test_rejects_cost_no_second_reading(spark, landed):
    """Good and bad rows of a batch come from the one query; rejects are there while a stream runs on."""
    query = start_raw_events(spark, landed, available_now=False)
    query.processAllAvailable()
    assert rejected_events(spark, landed).count() == 4 and len(spark.streams.active) == 1
    assert sum(p.numInputRows for p in query.recentProgress) == 28
    query.stop()


def test_a_killed_run_reports_all_its_batches(spark, cfg, monkeypatch):
    """The run dies after it has written the rows of its third batch, before the batch counts as done."""
    land(cfg, **{f"events_{i}__json": event(i) for i in range(60)}, bad__json="not json")
    written = raw_events.write_batch

    def dies(rows_, path, number, fmt):
        done = written(rows_, path, number, fmt)
        if number == 2 and path.endswith("raw_events"):
            raise RuntimeError("killed")
        return done

    monkeypatch.setattr(raw_events, "write_batch", dies)
    with pytest.raises(Exception, match="killed"):
        ingest_event_stream(spark, cfg)
    monkeypatch.setattr(raw_events, "write_batch", written)
    run = ingest_event_stream(spark, cfg)
    assert sorted(int(r.event_id) for r in run.table.collect()) == list(range(60))
    told = ingest_report(spark, cfg).orderBy("batch_id").collect()
    assert [r.batch_id for r in told] == list(range(7)) and len({r.run_id for r in told}) == 2
    assert sum(r.num_input_rows for r in told) == 61 and sum(r.rejected_rows for r in told) == 1
    assert [r.batch_id for r in run.report.orderBy("batch_id").collect()] == [2, 3, 4, 5, 6]
    assert rejected_events(spark, cfg).count() == 1


def test_a_batch_is_written_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert batches.write_batch(spark.range(3), path, 0)
    assert not batches.write_batch(spark.range(5), path, 0)
    with pytest.raises(Exception, match="no"):
        batches.write_batch(spark.range(9).selectExpr("raise_error('no') AS id"), path, 1)
    assert batches.write_batch(spark.range(3, 5), path, 1)
    found = spark.read.options(**batches.READ_OPTIONS).parquet(path)
    assert rows(found) == [(i,) for i in range(5)]


def test_folders_of_the_file_sink_are_refused(spark, cfg):
    Path(cfg.processed("raw_events"), "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="file sink"):
        start_raw_events(spark, cfg)


def test_a_stream_that_runs_on_says_whether_it_caught_up(spark, cfg):
    land(cfg, a__json=event(1))
    run = ingest_event_stream(spark, cfg, budget_seconds=8, available_now=False)
    assert (run.ended, run.caught_up) == (False, True)
    land(cfg, **{f"events_{i}__json": event(i) for i in range(400)})
    one = dataclasses.replace(cfg, files_per_batch=1)
    run = ingest_event_stream(spark, one, budget_seconds=3, available_now=False)
    assert (run.ended, run.caught_up) == (False, False)
