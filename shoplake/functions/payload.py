"""Events as JSON text."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.schemas import CORRUPT_RECORD, EVENT_SCHEMA

#: So many events may be taken by one task, which is what ``limit`` does.
ONE_TASK_ROWS = 1000
#: Copies of equal texts are made by tasks of about so many.
COPIES_PER_TASK = 1_000_000


def to_payload(events: DataFrame, pretty: bool = False) -> DataFrame:
    """One JSON object per event, in ``value``; absent attributes are left out."""
    options = {"pretty": "true"} if pretty else {}
    return events.select(F.to_json(F.struct(*events.columns), options).alias("value"))


def peek(events: DataFrame, n: int = 3) -> DataFrame:
    """Any ``n`` events as indented JSON, or all if there are no more.

    More than ``ONE_TASK_ROWS`` stay in their tasks: they are counted first, and cut only if there
    are too many. The events must then be the same whenever they are computed.
    """
    if n <= ONE_TASK_ROWS or events.isStreaming:
        return to_payload(events.limit(n), pretty=True)
    total = events.count()
    texts = to_payload(events, pretty=True)
    return texts if total <= n else cut_texts(texts, n, total)


def cut_texts(texts: DataFrame, n: int, total: int) -> DataFrame:
    """Any ``n`` of the ``total`` texts in ``value``, in many tasks; ``n`` is less than ``total``.

    A hash deals the texts out to about as many parts as a part has texts. Parts are taken whole
    until the next one would be too many. Of that one, equal texts are counted, and as many copies
    are made as are still wanted: one text may be the whole table.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(math.isqrt(total)))
    sizes = texts.groupBy(part.alias("part")).agg(F.count("value").alias("size"))
    before = F.sum("size").over(W.orderBy("part")) - F.col("size")
    fitting = sizes.select("part", before.alias("before")).where(F.col("before") <= n)
    last = fitting.agg(F.max("part").alias("part"), F.max("before").alias("before")).first()
    more = n - last.before

    equal = texts.where(part == last.part).groupBy("value").agg(F.count("value").alias("copies"))
    before = F.sum("copies").over(W.orderBy("value")) - F.col("copies")
    wanted = equal.select("value", F.least("copies", F.lit(more) - before).alias("wanted"))
    first = F.sequence(F.lit(1).cast("bigint"), "wanted", F.lit(ONE_TASK_ROWS).cast("bigint"))
    blocks = wanted.where("wanted > 0").withColumn("first", F.explode(first))
    end = F.least(F.col("first") + F.lit(ONE_TASK_ROWS - 1), F.col("wanted"))
    copies = blocks.repartition(1 + more // COPIES_PER_TASK).select(
        "value", F.explode(F.sequence("first", end))
    )
    return texts.where(part < last.part).unionByName(copies.select("value"))


def parse_payload(
    payloads: DataFrame, schema: T.StructType = EVENT_SCHEMA, column: str = "value"
) -> DataFrame:
    """Typed event columns by name: missing fields are NULL, unknown ones are dropped.

    Text that is not of the schema keeps what could be read and is kept whole in
    ``_corrupt_record``.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    parsed = F.from_json(
        column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}
    )
    return payloads.select(parsed.alias("event")).select("event.*")


def is_reject(schema: T.StructType = EVENT_SCHEMA) -> Column:
    """True for text of which no field could be read. A row with one bad field is kept."""
    nothing_read = F.coalesce(*[F.col(name).cast("string") for name in schema.names]).isNull()
    return F.col(CORRUPT_RECORD).isNotNull() & nothing_read


def json_int(text: Column | str, field: str) -> Column:
    """Integer field of a flat JSON object."""
    return F.from_json(text, f"`{field}` int")[field]
