from __future__ import annotations

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from llm_cases import ODD, clashing, empty_documents, given, odd_documents
from pyspark.sql import functions as F

from shoplake.llm import sharding as S


def placed(docs, n=24):
    return S.number(S.assign(docs, [1.0] * n), by=("doc_id", "text_crc32", "size"))


def test_given_documents(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01")
    rows = placed(docs).collect()
    assert len(rows) == docs.count()
    slots = {}
    for r in rows:
        content = (r["text"] or "").encode()
        assert r["size"] == len(content) + 8 and r["text_crc32"] == zlib.crc32(content)
        assert 0 <= r["shard"] < 24
        assert r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    assert 0.4 / 25 < sum(r["grown_shard"] == 24 for r in rows) / len(rows) < 2 / 25


def test_more_shards_move_records_only_to_themselves(spark):
    keys = spark.range(3000).withColumnRenamed("id", "key")
    for n in (1, 2, 7):
        before, after = (S.rendezvous(F.col("key"), [1.0] * k) for k in (n, n + 3))
        for r in keys.select(before.alias("a"), after.alias("b")).collect():
            assert r["a"] == r["b"] or r["b"] >= n


def test_weights_are_shares(spark):
    weights = [1.0, 2.0, 5.0]
    found = spark.range(8000).select(S.rendezvous(F.col("id"), weights).alias("s")).collect()
    counts = Counter(r["s"] for r in found)
    for k, w in enumerate(weights):
        assert counts[k] / 8000 == pytest.approx(w / 8, abs=0.02)
    with pytest.raises(ValueError):
        S.rendezvous(F.col("id"), [1.0, 0.0])


def test_odd_rows(spark):
    docs = clashing(odd_documents(spark), "Slot", "shard", "size", "_at", "_offset", "_shard", "a.b", "one_", "part_")
    rows = placed(docs, 3).collect()
    assert len(rows) == len(ODD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["shard"], r["grown_shard"]))
        if r["text"] is None:
            assert (r["size"], r["text_crc32"]) == (8, 0)
    assert all(len(s) == 1 for s in by_id.values())  # the key decides
    for s in range(3):
        found = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert found == list(range(len(found)))
    assert placed(empty_documents(spark)).collect() == []


def test_one_hot_key(spark):
    """All rows share a key: one shard, by the law, but many places."""
    docs = spark.range(500).select(F.lit(1).alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = placed(docs).collect()
    assert len({r["shard"] for r in rows}) == 1
    assert sorted(r["slot"] for r in rows) == list(range(500))


def test_the_choice_of_a_shard(spark):
    """Each record recomputed in plain Python: the highest -weight / ln(draw) wins."""
    weights = [1.0, 2.5, 0.5, 1.0]
    docs = given(spark, "documents").select("doc_id", "text")
    rows = S.assign(docs, weights, grown_weight=1.5).collect()
    for r in rows:
        scores = []
        for s, w in enumerate([*weights, 1.5]):
            first = xxhash.xxh64_intdigest(str(r["doc_id"]).encode(), seed=42)
            bits = xxhash.xxh64_intdigest(struct.pack("<i", s), seed=first) >> 11
            scores.append(-w / math.log((bits + 0.5) / (1 << 53)))
        assert r["shard"] == max(range(4), key=lambda s: scores[s])
        assert r["grown_shard"] == max(range(5), key=lambda s: scores[s])


def test_repeated_rows_are_numbered_in_many_ranges(spark):
    docs = spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    rows = S.number(S.assign(docs, [1.0] * 3), by=("doc_id", "text_crc32", "size")).collect()
    assert sorted(r["slot"] for r in rows) == list(range(5000))
