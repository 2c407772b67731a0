"""Running streaming queries to an end, and reporting what they did."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

SUCCESS = "SUCCESS"
WARNING = "WARNING"
INCOMPLETE = "INCOMPLETE"
REPORT_SCHEMA = (
    "query string, batch_id bigint, num_input_rows bigint, "
    "partial_rows bigint, rejected_rows bigint"
)
# Name of the row counts a query may keep beside its input rows.
QUALITY = "quality"
#: How often progress is taken over. Spark keeps the last 100 batches at least, far more than
#: can pass in this time, so no batch is missed.
POLL_SECONDS = 0.25


def triggered(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    """Either drain what is there and end, or run on until stopped."""
    return writer.trigger(availableNow=True) if available_now else writer


class RunLog:
    """The counts of every batch of the queries of one run."""

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], tuple[Any, ...]] = {}
        #: Whether nothing was left to read when the run ended or was stopped.
        self.caught_up = False

    def take(self, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            if progress.numInputRows > 0:
                quality = progress.observedMetrics.get(QUALITY)
                counts = tuple(quality) if quality else (None, None)
                self.batches[query.name, progress.batchId] = (progress.numInputRows, *counts)

    def report(self, spark: SparkSession) -> DataFrame:
        """Input rows of each batch of each query, and how many of them were not clean."""
        rows = [(*key, *counts) for key, counts in self.batches.items()]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


def run_bounded(
    queries: list[StreamingQuery], budget_seconds: float | None = None, log: RunLog | None = None
) -> bool:
    """Wait for the queries, at most the budget in all if there is one; stop those that still run.

    True if all ended by themselves. A stopped query goes on from its checkpoint when it is
    started again. ``log`` takes the progress meanwhile.
    """
    log = log or RunLog()
    deadline = None if budget_seconds is None else time.monotonic() + budget_seconds
    try:
        while True:
            active = [q for q in queries if q.isActive]
            left = POLL_SECONDS if deadline is None else deadline - time.monotonic()
            if not active or left <= 0:
                break
            active[0].awaitTermination(max(0.001, min(left, POLL_SECONDS)))
            for query in queries:
                log.take(query)
        ended = not active
        log.caught_up = not any(q.status["isDataAvailable"] for q in active)
        for query in queries:
            if not query.isActive:
                query.awaitTermination(1)  # raises if the query failed
    finally:
        for query in queries:
            query.stop()
            log.take(query)
    return ended


def outcome(report: DataFrame, ended: bool = True) -> str:
    """INCOMPLETE for a run cut short; else SUCCESS if any rows were processed, or WARNING."""
    if not ended:
        return INCOMPLETE
    return WARNING if report.where(F.col("num_input_rows") > 0).isEmpty() else SUCCESS
