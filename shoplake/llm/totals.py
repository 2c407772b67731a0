"""Sums of counts over many senders, told to each sender for its own keys, and for each key which sender owns it.

A sender has sorted 64-bit keys with counts and wants, for each of its keys, the sum over all senders. Keys
are spread evenly over the numbers (hashes, or numbers that were mixed), and go to equal ranges of them. A group adds
up what at most ``FAN`` senders have in a range. With more senders this takes rounds: what a group has added up
is sent on like that of a sender, to groups of ``FAN`` groups and to finer ranges; the answers come back the same way. So each
sender and each group sends at most ``FAN`` rows, and the rows grow with the senders, not with their square.
A group is never larger than what ``FAN`` senders have in one range, and a key that all senders have is
one number of each. Each key has one owner among the senders that have it, so that a sum over all senders can
count a key once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import bins_for, stored

#: Most senders whose keys meet at a time, and most ranges that keys are cut into at a time.
FAN = 256
#: Keys of all senders in one range, about.
RANGE_KEYS = 2_000_000

ROW = "sender string, address string, batch long, range long, keys binary, counts binary"
ANSWER = "sender string, range long, totals binary"


def pack(numbers: np.ndarray) -> bytes:
    """Numbers with their bytes sorted by weight, compressed."""
    raw = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize)
    return zstandard.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "u8"), dtype=np.uint64)


def ends_of(keys: np.ndarray, ranges: int) -> list[int]:
    """Where each of the equal ranges of numbers ends in sorted keys."""
    tops = np.array([(b << 64) // ranges for b in range(1, ranges)], np.uint64)
    return [*np.searchsorted(keys, tops).tolist(), len(keys)]


def cut(
    sender: str, keys: np.ndarray, counts: np.ndarray, ranges: int, batch: int, level: int
) -> list[tuple[str, str, int, int, bytes, bytes]]:
    ends = ends_of(keys, ranges)
    return [
        (sender, f"{level}.{batch}.{r}", batch, r, pack_sorted(keys[s:e]), pack(counts[s:e]))
        for r, (s, e) in enumerate(zip([0, *ends[:-1]], ends, strict=True))
        if e > s
    ]


def first_rows(asked: DataFrame, batches: int, ranges: int) -> DataFrame:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for sender, keys, counts in zip(frame["sender"], frame["keys"], frame["counts"], strict=True):
                batch = zlib.crc32(sender.encode()) % batches
                rows = cut(sender, unpack_sorted(keys), unpack(counts, "u8"), ranges, batch, 0)
                yield pd.DataFrame(rows, columns=["sender", "address", "batch", "range", "keys", "counts"])

    return asked.select("sender", "keys", "counts").mapInPandas(run, ROW)


def added(frame: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The keys of each row, the distinct ones, where each first is, the places of all in them, and their sums."""
    keys = [unpack_sorted(k) for k in frame["keys"]]
    counts = np.concatenate([unpack(c, "u8") for c in frame["counts"]])
    distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    sums = np.zeros(len(distinct), np.uint64)
    np.add.at(sums, place, counts)
    return keys, distinct, first, place, sums


def sent_on(rows: DataFrame, ranges: int, level: int) -> DataFrame:
    """What each group has added up, to the groups of the next round."""

    def run(key: tuple[str], frame: pd.DataFrame) -> pd.DataFrame:
        _, distinct, _, _, sums = added(frame)
        out = cut(key[0], distinct, sums, ranges, int(frame["batch"].iloc[0]) // FAN, level)
        return pd.DataFrame(out, columns=["sender", "address", "batch", "range", "keys", "counts"])

    return rows.groupBy("address").applyInPandas(run, ROW)


def told(
    frame: pd.DataFrame, keys: list[np.ndarray], first: np.ndarray, place: np.ndarray, values: np.ndarray
) -> pd.DataFrame:
    """An answer for each row. ``values``: twice the sum of each distinct key, and one more if it is owned here."""
    mine = values[place] & ~np.uint64(1)
    mine[first] = values
    ends = np.cumsum([len(k) for k in keys])
    found = [pack(mine[e - len(k) : e]) for k, e in zip(keys, ends, strict=True)]
    return pd.DataFrame({"sender": frame["sender"], "range": frame["range"], "totals": found})


def first_answers(rows: DataFrame) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("sender", ignore_index=True)
        keys, _, first, place, sums = added(frame)
        return told(frame, keys, first, place, 2 * sums + np.uint64(1))

    return rows.groupBy("address").applyInPandas(run, ANSWER)


def told_back(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers to the groups, handed to those that sent to them."""

    def run(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("sender", ignore_index=True)
        keys, _, first, place, _ = added(frame)
        return told(frame, keys, first, place, answered(above))

    given = answers.select(F.col("sender").alias("group"), F.col("range").alias("part"), "totals")
    return rows.groupBy("address").cogroup(given.groupBy("group")).applyInPandas(run, ANSWER)


def answered(answers: pd.DataFrame) -> np.ndarray:
    """What one sender was told, in the order of its keys: twice the totals, and one more for keys it owns."""
    by = "range" if "range" in answers else "part"
    parts = [unpack(t, "u8") for t in answers.sort_values(by)["totals"]]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def joined(answers: pd.DataFrame) -> np.ndarray:
    """The totals of one sender, in the order of its keys."""
    return answered(answers) >> np.uint64(1)


def owned(answers: pd.DataFrame) -> np.ndarray:
    """Which of its keys one sender owns."""
    return (answered(answers) & np.uint64(1)).astype(bool)


def totals(asked: DataFrame, n_senders: int, n_keys: int, label: str) -> DataFrame:
    """(sender, range, totals), stored: ``joined`` makes one list of a sender's rows.

    ``asked`` has a row for each sender, with distinct names: keys by ``pack_sorted``, counts by ``pack`` as 64-bit numbers.
    """
    ranges, batches, level = bins_for(n_keys, RANGE_KEYS), bins_for(n_senders, FAN), 0
    wide = FAN
    sent = first_rows(asked, batches, min(wide, ranges))
    rounds = [stored(sent, label) if batches > 1 else sent]
    while batches > 1:
        wide, level, batches = wide * FAN, level + 1, bins_for(batches, FAN)
        rounds.append(stored(sent_on(rounds[-1], min(wide, ranges), level), label))
    answers = first_answers(rounds.pop())
    while rounds:
        answers = told_back(rounds.pop(), stored(answers, label))
    return stored(answers, label)
