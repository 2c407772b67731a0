"""The jobs run in order from the command line, over one lakehouse."""

from __future__ import annotations

import json
from pathlib import Path

from fixtures import ITEMS, ORDERS, write_raw

from shoplake.__main__ import main
from shoplake.config import BRIDGED, EVENT_LANDING


def test_all_commands(spark, cfg, capsys):
    def run(command, *more):
        main([command, "--root", cfg.root, "--database", cfg.database, *more], spark)
        return capsys.readouterr().out

    write_raw(cfg, orders=ORDERS, order_items=ITEMS)
    assert f"loaded {cfg.database}.orders" in run("ingest")
    assert "order_purchase_timestamp" in run("profile")
    run("facts")
    assert "55.75" in run("metrics")
    assert "2018-01-01" in run("metrics", "--date", "2018-01-01", "--write-mode", "append")
    landing = Path(cfg.temp(EVENT_LANDING))
    landing.mkdir(parents=True)
    (landing / "events_1.json").write_text(json.dumps({"event_id": "1"}))
    assert "SUCCESS" in run("events")
    assert "WARNING" in run("events")


def test_bridge_command(spark, cfg, capsys):
    more = ["--source", "rate", "--option", "rowsPerSecond=5", "--keep-running", "--seconds", "6"]
    main(["bridge", "--root", cfg.root, *more], spark)
    assert "SUCCESS" in capsys.readouterr().out
    landed = spark.read.text(cfg.temp(EVENT_LANDING, BRIDGED))
    assert landed.count() > 0
