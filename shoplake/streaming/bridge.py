"""From a message stream to event files in the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shoplake.config import BRIDGED, EVENT_LANDING, LakeConfig
from shoplake.streaming.runs import QUALITY, triggered

BRIDGE = "bridge"


def start_bridge(
    bodies: DataFrame,
    cfg: LakeConfig,
    one_event_per_file: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Land message bodies (text in ``value``) unchanged, one JSON object per line.

    Line breaks in JSON can only stand between tokens, so a body over several lines becomes
    one line of the same meaning. NULL and blank bodies have nothing to land; the run's report counts
    them as rejected rows. The checkpoint and the sink's commit log land each message once, also
    over restarts; a landing folder takes one bridge. One file per event is slow on object
    stores: ask for it only where a consumer needs it.
    """
    body = F.col("value").cast("string")
    blank = body.isNull() | (F.trim(F.translate(body, "\r\n\t", "   ")) == "")
    lines = (
        bodies.observe(
            QUALITY, F.count_if(F.lit(False)).alias("partial_rows"), F.count_if(blank).alias("rejected_rows")
        )
        .where(~blank)
        .select(F.translate(body, "\r\n", "  ").alias("value"))
    )
    writer = (
        lines.writeStream.format("text")
        .queryName(f"{cfg.database}.{BRIDGE}")
        .outputMode("append")
        .option("checkpointLocation", cfg.checkpoint(BRIDGE))
        .option("path", cfg.temp(EVENT_LANDING, BRIDGED))
    )
    if one_event_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    return triggered(writer, available_now).start()
