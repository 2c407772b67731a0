"""What several operators need: shared scratch tables, Arrow slices, caches of worker processes."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.config import scratch_dir

#: Most rows of one long column that are ever broadcast: 16 MB of ids.
BROADCAST_ROWS = 2_000_000
#: Most bytes of text and other binary values in such rows.
BROADCAST_BYTES = 32 * 1024 * 1024
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000
#: Bytes of text a worker has as Python objects at a time (one longer text counts alone).
SLICE_BYTES = 512 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: it is computed once and outlives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named(column: str) -> str:
    """A column's name as Spark reads it, also with dots or quotes inside."""
    return "`" + column.replace("`", "``") + "`"


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def doc_crc(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with a stored ``right`` that is broadcast only when measured to be small, else shuffled."""
    return left.join(F.broadcast(right) if is_small(right) else right, on, how)


def is_small(rows: DataFrame) -> bool:
    """Whether a stored table has at most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` of text in them."""
    texts = [F.octet_length(named(f.name)) for f in rows.schema if f.dataType.typeName() in ("string", "binary")]
    held = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0)).cast("long")
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(held), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


def small_batches(docs: DataFrame) -> DataFrame:
    """Have the session hand texts to Python in batches of at most ``BATCH_ROWS``, and return ``docs``.

    The usual 10,000 texts are some 40 MB, which each task holds several times outside the heap. A
    smaller setting stays as it is; it is never raised again, and rows don't depend on it.
    """
    spark = docs.sparkSession
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return docs


def worker_cache() -> dict[Any, Any]:
    """Lasts as long as the Python worker, over its tasks."""
    name = "_shoplake_llm_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].kept = {}
    return sys.modules[name].kept


def cached(key: Any, make: Callable[[], Any]) -> Any:
    """A value that a worker builds once per key; only the newest 8 are kept."""
    kept = worker_cache()
    if key not in kept:
        while len(kept) >= 8:
            kept.pop(next(iter(kept)))
        kept[key] = make()
    return kept[key]


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def bins_for(amount: float, per_bin: float) -> int:
    """How many groups of about ``per_bin`` an amount is dealt to."""
    return max(1, math.ceil(amount / per_bin))


def under_private_names(
    docs: DataFrame, columns: Sequence[str], run: Callable[..., DataFrame]
) -> DataFrame:
    """``run(docs, *columns)`` where all columns have names that clash with none; its rows come back under the given ones."""
    names = docs.columns
    private = [f"given{k}" for k in range(len(names))]
    made = run(docs.toDF(*private), *[private[names.index(c)] for c in columns])
    return made.select(*private).toDF(*names)


def map_batches(
    df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` for columns of any name, also with dots, which it does not find by itself."""
    names = df.columns
    inner = T.StructType([T.StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema)])
    arrow = to_arrow_schema(inner)

    def renamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)
        for out in run(given):
            yield pa.RecordBatch.from_arrays(out.columns, schema=arrow)

    return df.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(renamed, inner).toDF(*schema.names)


def running(rows: DataFrame, group: str, order: Sequence[str | Column], amount: str, before: str, total: str) -> DataFrame:
    """Adds the sum of ``amount`` over the earlier rows of the group (``before``) and over all of them (``total``).

    ``group`` and ``amount`` are columns of whole numbers without NULLs. Rows that are equal in ``order`` are told
    apart by their place in a stored copy, so a group that repeats one row is split like any other: rows
    lie in ranges of (group, order, place), each range adds up its own, and only the sums of ranges are
    joined back. What comes out is stored, in that order.
    """
    part, place, local = (unused([*rows.columns, before, total], n) for n in ("part_", "place_", "local_"))
    keys = [unused(rows.columns, f"order{k}_") for k in range(len(order))]
    asked = {k: F.col(named(o)) if isinstance(o, str) else o for k, o in zip(keys, order, strict=True)}
    given = stored(rows.withColumns({**asked, place: F.monotonically_increasing_id()}), "running")
    by = [group, *keys, place]
    dealt = given.repartitionByRange(*map(named, by)).sortWithinPartitions(*map(named, by)).drop(*keys, place)
    schema = T.StructType(
        [
            *[f for f in rows.schema if f.name not in (before, total)],
            T.StructField(part, T.IntegerType()),
            T.StructField(local, T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    names = [f.name for f in rows.schema if f.name not in (before, total)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        last, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(group).to_numpy(zero_copy_only=False)
            amounts = batch.column(amount).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(amounts) - amounts
            new = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            sizes = np.diff(np.append(new, len(groups)))
            here = sums - np.repeat(sums[new], sizes)
            if groups[0] == last:
                here[: sizes[0]] += held
            last, held = groups[-1], int(here[-1] + amounts[-1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(np.full(len(here), number, np.int32)), pa.array(here)],
                schema=arrow,
            )

    placed = stored(map_batches(dealt.select(*map(named, names)), run, schema), "ranges")
    sums = placed.groupBy(named(group), named(part)).agg(F.sum(named(amount)).cast("long").alias("sum"))
    whole = W.partitionBy(named(group))
    earlier = whole.orderBy(named(part)).rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(
        sums.select(
            named(group),
            named(part),
            F.coalesce(F.sum("sum").over(earlier), F.lit(0)).cast("long").alias(before),
            F.sum("sum").over(whole).cast("long").alias(total),
        ),
        "offsets",
    )
    told = join_small(placed, offsets, [group, part], "inner")
    return told.select(
        *map(named, names), (F.col(named(before)) + F.col(named(local))).alias(before), named(total)
    )
