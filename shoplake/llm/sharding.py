"""Weighted rendezvous hashing of record keys over shards, with gapless places inside each shard.

Every shard draws a number from a hash of (key, shard) and the record goes to the highest
``-weight / ln(draw)``. A new shard only wins records for itself, so nothing else moves.
All of it is one expression per row.

Places are numbered without collecting a shard: rows lie in ranges of (shard, hash of content, number in a stored copy), each
range counts its own, and the counts of ranges are the offsets (``common.running``). Rows that are
equal in all columns share a hash, but not the number, so they are split over ranges like any others.

Defined results: NULL keys draw like the empty text; equal keys always share a shard, and a hot
key therefore makes its shard large, as the law demands, while its rows still spread over
ranges. NULL text has 8 bytes and CRC 0. Columns are kept unless a result has
the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import named, running, unused

RESULTS = {"size", "text_crc32", "shard", "slot", "grown_shard"}


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that depends on key and shard only."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    bits = F.shiftrightunsigned(F.xxhash64(text, shard.cast("int")), 11)
    return (bits + 0.5) / float(1 << 53)


def scores(key: Column, weights: Sequence[float], first: int = 0) -> list[Column]:
    """(score, -shard) of each shard, so that the lower shard wins a tie."""
    if min(weights) <= 0:
        raise ValueError("weights must be positive")
    return [
        F.struct(
            (-float(w) / F.log(draw(key, F.lit(first + s)))).alias("score"),
            F.lit(-(first + s)).alias("shard"),
        )
        for s, w in enumerate(weights)
    ]


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to n-1) of a key."""
    best = F.greatest(*scores(key, weights)) if len(weights) > 1 else scores(key, weights)[0]
    return (-best["shard"]).cast("int")


def assign(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    grown_weight: float = 1.0,
) -> DataFrame:
    """Adds size, text_crc32, shard and, if one shard more were added, grown_shard."""
    content = F.coalesce(F.col(text), F.lit(""))
    kept = [named(c) for c in docs.columns if c.lower() not in RESULTS]
    return docs.select(
        *kept,
        (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, grown_weight]).alias("grown_shard"),
    )


def number(rows: DataFrame, shard: str = "shard", by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Adds slot: 0 to n-1 within each shard, in the order of a hash of ``by``."""
    rows = rows.drop(*[c for c in rows.columns if c.lower() == "slot"])
    one, total, group = (unused(rows.columns, n) for n in ("one_", "total_", "group_"))
    counted = rows.withColumns({one: F.lit(1).cast("long"), group: F.col(named(shard)).cast("long")})
    columns = [F.col(named(c)) for c in by]
    told = running(counted, group, [F.xxhash64(*columns), *columns], one, "slot", total)
    return told.drop(one, total, group)
