from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD, ascii_lower, clashing, empty_documents, given, odd_documents
from pyspark.sql import functions as F

from shoplake.llm import lm_score as M
from shoplake.llm import totals
from shoplake.llm.common import doc_crc


def brute(rows):
    """(n_tokens, n_known, base_score, score) of each (learned from, text), word by word."""
    texts = [(t, re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(x)) + ["\n"]) for t, x in rows]
    seen = Counter(w for t, ws in texts if t for w in ws)
    pairs = Counter(p for t, ws in texts if t for p in zip(ws, ws[1:], strict=False))
    triples = Counter(p for t, ws in texts if t for p in zip(ws, ws[1:], ws[2:], strict=False))
    followers = Counter(a for a, _ in pairs)
    n, v = seen.total(), len(seen)
    out = []
    for _, words in texts:
        base = there = 0.0
        for i, w in enumerate(words):
            root = p = (seen[w] + 1) / (n + v + 1)
            if i and seen[h := words[i - 1]]:
                arc = max(pairs[h, w] - M.DISCOUNT, 0) / seen[h]
                p = arc + M.DISCOUNT * followers[h] / seen[h] * p
            if i > 1 and pairs[words[i - 2], words[i - 1]] >= M.LEAST_PAIR:
                state = pairs[words[i - 2], words[i - 1]]
                p = triples[words[i - 2], words[i - 1], w] / (state + M.PRIOR) + M.PRIOR / (state + M.PRIOR) * p
            base += math.log10(root)
            there += math.log10(p)
        out.append((len(words), sum(seen[w] > 0 for w in words), base, there))
    return out, n


def compare(df, train):
    rows = df.withColumn("_train", F.coalesce(train, F.lit(False))).select("_train", "text", "doc_id").collect()
    want, n = brute([(r[0], r[1]) for r in rows])
    got = M.score(df, train).collect()
    assert len(got) == len(rows)
    key = lambda r: tuple(round(x, 6) for x in r)
    told = sorted(
        (repr(r["doc_id"]), *key((r["n_tokens"], r["n_known"], r["base_score"], r["score"]))) for r in got
    )
    expected = sorted((repr(r[2]), *key(w)) for r, w in zip(rows, want, strict=True))
    for a, b in zip(told, expected, strict=True):
        assert a[:3] == b[:3]
        assert a[3:] == pytest.approx(b[3:], abs=1e-5)
    assert {r["train_tokens"] for r in got} <= {n}


@pytest.mark.parametrize("block,keys,fan", [(1_000_000, 2_000_000, 256), (3000, 4000, 256), (2000, 3000, 3)])
def test_given_documents(spark, monkeypatch, block, keys, fan):
    """Also in many blocks and ranges, and in several rounds."""
    monkeypatch.setattr(M, "BLOCK_WORDS", block)
    monkeypatch.setattr(totals, "RANGE_KEYS", keys)
    monkeypatch.setattr(totals, "FAN", fan)
    compare(given(spark, "documents"), doc_crc() % 7 != 2)


def test_requests_grow_with_the_blocks(spark, monkeypatch):
    """Four times the blocks make about four times the rows (and a round more), not sixteen times."""
    monkeypatch.setattr(totals, "FAN", 4)
    monkeypatch.setattr(totals, "RANGE_KEYS", 50)
    sent = []
    rows_of = totals.stored

    def counted(df, label):
        told = rows_of(df, label)
        if "address" in told.columns:
            sent.append(told.count())
        return told

    monkeypatch.setattr(totals, "stored", counted)
    monkeypatch.setattr(M, "BLOCK_WORDS", 1)
    found = {}
    for n in (20, 80):
        docs = spark.range(n).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 60), k -> sha(concat(id, k % 30))), ' ') AS text")
        del sent[:]
        blocks = M.stored(M.coded_blocks(docs, "doc_id", "text", F.lit(True)), "blocks")
        keys = blocks.selectExpr("block AS sender", "words AS keys", "counts")
        totals.totals(keys, n, n * 30, "test").count()
        found[n] = sum(sent)
    assert 4 * 20 <= found[20] and found[80] <= 8 * found[20]


def test_odd_rows(spark):
    docs = clashing(odd_documents(spark), "score", "block", "train")
    compare(docs, F.col("doc_id").isNotNull())
    assert len(ODD) == M.score(docs, F.lit(None).cast("boolean")).count()


def test_nothing_to_learn_from(spark):
    told = M.score(odd_documents(spark), F.lit(False)).collect()
    assert {(r["score"], r["base_score"], r["n_known"], r["train_tokens"]) for r in told} == {(0.0, 0.0, 0, 0)}
    assert M.score(empty_documents(spark), F.lit(True)).collect() == []


def test_probabilities_add_up_to_one():
    """Over all known words and the share of unknown ones, after each state: the failure arcs are chained."""
    texts = [list("abcabdab"), list("bcab"), list("cc")]
    tokens = [w for t in texts for w in [*t, "."]]
    seen = Counter(tokens)
    pairs = Counter(p for t in texts for p in zip(t, [*t[1:], "."], strict=True))
    triples = Counter(p for t in texts for p in zip(t, [*t[1:], "."], [*t[2:], "."], strict=False) if p[1] != ".")
    a = M.Automaton(len(tokens), len(seen))
    unknown = 1 / (len(tokens) + len(seen) + 1)
    number = lambda x: np.array([float(x)])
    assert sum(a.root(number(seen[w]))[0] for w in seen) + unknown == pytest.approx(1)
    for h in "abcd":
        followers = number(sum(1 for p in pairs if p[0] == h))
        one = {
            w: a.after_word(number(pairs[h, w]), number(seen[h]), followers, a.root(number(seen[w]))) for w in seen
        }
        fail = a.after_word(number(0), number(seen[h]), followers, number(unknown))[0]
        assert sum(p[0] for p in one.values()) + fail == pytest.approx(1)
        for g in "abcd":
            if pairs[g, h] >= M.LEAST_PAIR:
                state = number(pairs[g, h])
                two = sum(a.after_pair(number(triples[g, h, w]), state, one[w])[0] for w in seen)
                assert two + a.after_pair(number(0), state, number(fail))[0] == pytest.approx(1)


def test_packing():
    dice = np.random.Generator(np.random.Philox(1))
    keys = np.unique(dice.integers(0, 1 << 64, 1000, dtype=np.uint64, endpoint=False))
    assert (M.unpack_sorted(M.pack_sorted(keys)) == keys).all()
    assert len(M.unpack_sorted(M.pack_sorted(keys[:0]))) == 0
    codes = dice.integers(0, 1000, 500).astype(np.uint32)
    assert (M.unpack(M.pack(codes), "u4") == codes).all()


def test_held_out_texts_score_better_than_at_the_root(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01")
    told = [r for r in M.score(docs, doc_crc() % 7 != 2).collect() if not r["train"]]
    assert sum(r["score"] for r in told) > sum(r["base_score"] for r in told)
    for r in told:
        assert not r["train"] and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2


def test_a_rare_word_is_a_state_in_a_large_corpus(spark):
    """A pair whose first word is 1 of 60,000 tokens scores by its arc."""
    rows = [(0, "rare follower"), (1, "rare follower"), (2, "rare follower")]
    rows += [(k, "common " * 1000) for k in range(3, 203)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(docs, F.col("doc_id") != 2)
    (told,) = M.score(docs, F.col("doc_id") != 2).where("doc_id = 2").collect()
    assert told["score"] - told["base_score"] > 4  # follower and end are nearly certain now


def test_more_states_than_sixteen_bits_hold(spark):
    text = " ".join(f"w{k}" for k in range(70_000))
    docs = spark.createDataFrame([(0, text), (1, text), (2, "w69998 w69999 w1")], "doc_id long, text string")
    compare(docs, F.col("doc_id") < 2)


def test_a_pair_seen_once_scores_better_than_one_never_seen(spark):
    docs = spark.createDataFrame([(0, "a b c d"), (1, "a b c d"), (2, "d c b a")], "doc_id long, text string")
    compare(docs, F.col("doc_id") == 0)
    told = {r["doc_id"]: r for r in M.score(docs, F.col("doc_id") == 0).collect()}
    assert told[1]["base_score"] == pytest.approx(told[2]["base_score"])
    assert told[1]["score"] > told[1]["base_score"] > told[2]["score"]


def test_a_text_that_occurs_twice_stands_apart(spark):
    """Its words follow pairs that were seen twice, which is rare elsewhere."""
    dice = np.random.default_rng(6)
    texts = [" ".join(f"w{int(k)}" for k in dice.zipf(1.3, 150) % 3000) for _ in range(300)]
    rows = list(enumerate(texts + texts[:30]))
    told = M.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()
    per = {r["doc_id"]: r["score"] / r["n_tokens"] for r in told}
    again = [v for k, v in per.items() if k < 30 or k >= 300]
    once = sorted(v for k, v in per.items() if 30 <= k < 300)
    assert len(again) == 60 and sum(v > once[int(0.95 * len(once))] for v in again) > 0.9 * len(again)
