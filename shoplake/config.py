"""Where a lakehouse lives and what its tables are called."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from shoplake.schemas import KNOWN_COLUMN_TYPES

# Zone, database, table and folder names existing queries rely on.
ZONES = ("raw", "processed", "presentation", "temp")
DATABASE = "ecommerce_db"
FACT_TABLE = "fact_orders"
FACT_DAYS_TABLE = "fact_orders_days"
METRICS_TABLE = "daily_order_metrics"
RAW_EVENTS_TABLE = "raw_events"
EVENT_LANDING = "event-stream-input"
EVENT_ARCHIVE = "event-stream-archive"
# The bridge lands in a folder of its own: its commit log says which of the files there count,
# and must not hide what other producers put beside it.
BRIDGED = "bridged"

# Fixed value: operating limit of the streaming jobs.
FILES_PER_BATCH = 10


@dataclass(frozen=True)
class LakeConfig:
    """One lakehouse: a root folder with four zones and one catalog database.

    ``fmt`` is any batch-and-streaming file format the cluster has ("parquet", "orc",
    or a table format whose jar is installed). ``column_types`` types known CSV columns
    by name; columns it does not list are inferred.
    """

    root: str
    database: str = DATABASE
    fmt: str = "parquet"
    orders_table: str = "orders"
    items_table: str = "order_items"
    products_table: str = "products"
    column_types: dict[str, str] = field(default_factory=lambda: dict(KNOWN_COLUMN_TYPES))
    multi_line_tables: frozenset[str] = frozenset()
    fact_by_month: bool = False
    files_per_batch: int = FILES_PER_BATCH
    archive_landed: bool = False

    def zone(self, zone: str, *parts: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}; expected one of {ZONES}")
        return "/".join([self.root.rstrip("/"), zone, *parts])

    def raw(self, *parts: str) -> str:
        return self.zone("raw", *parts)

    def processed(self, *parts: str) -> str:
        return self.zone("processed", *parts)

    def presentation(self, *parts: str) -> str:
        return self.zone("presentation", *parts)

    def temp(self, *parts: str) -> str:
        return self.zone("temp", *parts)

    def database_folder(self) -> str:
        """Where tables go that are saved into the database without a path."""
        return f"{self.root.rstrip('/')}/{self.database}.db"

    def checkpoint(self, name: str) -> str:
        return self.temp("checkpoints", name)

    def table(self, name: str) -> str:
        return f"{quoted(self.database)}.{quoted(name)}"


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


#: Folders of sessions on one machine that have no shared folder set.
_OWN_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    A session on one machine that lacks this setting gets one folder, which is removed when
    Python ends; on a cluster the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.conf.get("spark.app.id", "")
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="shoplake-")
            atexit.register(shutil.rmtree, _OWN_ROOTS[app], ignore_errors=True)
        shared = _OWN_ROOTS[app]
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below a folder that ends with the application."""
    own = f"{shared_root(spark)}/shoplake-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{own}/{label}-{uuid.uuid4().hex}"
