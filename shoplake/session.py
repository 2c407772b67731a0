"""Session settings the jobs are written for."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SHUFFLE_BYTES_PER_TASK = 128 * 1024 * 1024
SCAN_BYTES_PER_TASK = 256 * 1024 * 1024

# A shuffle has (scan tasks x shuffle partitions) blocks. Beyond these numbers bigger tasks, which
# can spill, cost less than ever smaller blocks: 100 TB is 100,000 tasks of 1 GB.
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_PARTITIONS = 20_000

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES_PER_TASK),
    "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES_PER_TASK),
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
}


def local_session(cores: int | str = "*", app: str = "shoplake", **conf: str) -> SparkSession:
    """A one-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def conf_for(n_bytes: int) -> dict[str, str]:
    """Settings for a session whose largest input has ``n_bytes``, to be given when it starts.

    Adaptive execution begins shuffles with this many partitions and merges those that come out
    small: 200 partitions of a 100 TB shuffle would be 500 GB each. Jobs of this package never
    change settings themselves, so several of them can share a session.
    """
    wanted = min(math.ceil(n_bytes / SHUFFLE_BYTES_PER_TASK), MAX_SHUFFLE_PARTITIONS)
    scan = max(SCAN_BYTES_PER_TASK, math.ceil(n_bytes / MAX_SCAN_TASKS))
    return {
        **SESSION_CONF,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(200, wanted)),
        "spark.sql.files.maxPartitionBytes": str(scan),
    }
