"""Streams of events: files landed as JSON lines, and message buses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.config import BRIDGED, FILES_PER_BATCH
from shoplake.schemas import CORRUPT_RECORD, EVENT_SCHEMA
from shoplake.sources.files import list_files, make_folder

MESSAGES_PER_BATCH = 10_000_000

# Event files of any producer, also compressed. The name has to end so: producers finish a file under another
# name (x.json.tmp, x.json._COPYING_) and then rename it. What else lies in the folder, such as marker
# files and files in the making, is not read, and ``skipped_files`` names it.
EVENT_ENDINGS = ("json", "jsonl", "ndjson")
PACKED_ENDINGS = ("gz", "bz2", "deflate", "lz4", "snappy", "zst")
ENDINGS = [f"{e}{p}" for e in EVENT_ENDINGS for p in ("", *[f".{x}" for x in PACKED_ENDINGS])]
EVENT_FILES = "{" + ",".join(f"*.{e}" for e in ENDINGS) + "}"


def read_event_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = EVENT_SCHEMA,
    files_per_batch: int | None = FILES_PER_BATCH,
    bytes_per_batch: int | None = None,
    glob: str | None = EVENT_FILES,
    archive: str | None = None,
) -> DataFrame:
    """Stream of landed events with a fixed schema, and the text of lines that do not parse.

    A batch is limited by ``bytes_per_batch`` where given, else by number of files. Files that were read are
    moved to the folder ``archive`` where given, so that the listing does not grow for ever.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    reader = (
        spark.readStream.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive:
        make_folder(spark, archive)
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    elif files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def read_landing(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = EVENT_SCHEMA,
    files_per_batch: int | None = FILES_PER_BATCH,
    bytes_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream of events of all producers: files in the folder, and what the bridge committed.

    The limits of a batch hold for each of the two. Only files of other producers go to ``archive``: the bridge's
    belong to its commit log.
    """
    bridged = f"{folder}/{BRIDGED}"
    for path in (folder, bridged):
        make_folder(spark, path)
    limits = (schema, files_per_batch, bytes_per_batch)
    foreign = read_event_files(spark, folder, *limits, archive=archive)
    return foreign.unionByName(read_event_files(spark, bridged, *limits, glob=None))


def skipped_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of files beside the event files, which are not read: also those that a producer has not finished."""
    inside = F.substring_index("path", f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    names = list_files(spark, folder).where(~F.startswith(inside, F.lit(f"{BRIDGED}/"))).select("name")
    return names.where(~F.col("name").rlike(r"\.(" + "|".join(ENDINGS).replace(".", r"\.") + ")$"))


def read_bus(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Stream of message bodies as text in ``value``, from the earliest offset.

    ``fmt="kafka"`` needs the Kafka connector on the class path. Its batches are limited, as the
    first one would else be all that the topic retains. ``schema`` is an option for file formats.
    """
    defaults = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": str(MESSAGES_PER_BATCH)}
    schema = options.pop("schema", None)
    reader = spark.readStream.format(fmt).options(**{**(defaults if fmt == "kafka" else {}), **options})
    stream = (reader.schema(schema) if schema else reader).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_table_files(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Stream of rows from the files of a table folder, oldest files first."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)
