from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import ascii_lower, clashing, empty_documents, odd_documents

from shoplake.llm import phrases as P
from shoplake.llm import totals


def brute(rows, least, cover=80, top=2000):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", ascii_lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    count[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in often.items():
            for k in range(2, len(p)):
                covered |= {s for i in range(len(p) - k + 1) if 100 * a >= cover * f[s := p[i : i + k]]}
        found = []
        for p, a in often.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def made_up(n=300, seed=3):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "é", "a-b", "x", "y", "z'"]
    marks = [" ", " ", " ", " ", " ", "\t", ", ", ".", "\n", " ! "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.choice([4, 10])]) + rng.choice(marks) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "de", None, "und"]), text if rng.random() < 0.95 else None))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def found_in(docs, least, **settings):
    return sorted(tuple(r) for r in P.best_of_each(P.collocations(docs, least, **settings)).collect())


def test_against_brute_force(spark):
    rows = made_up()
    assert found_in(table(spark, rows), 5) == brute(rows, 5)
    assert len(brute(rows, 5)) > 40


@pytest.mark.parametrize("hot", [3, 40, 10**6])
def test_many_shards_in_rounds(spark, monkeypatch, hot):
    """Several rounds of small ranges, with few, some or all words hot: the same phrases."""
    monkeypatch.setattr(P, "FAN", 3)
    monkeypatch.setattr(totals, "FAN", 3)
    monkeypatch.setattr(totals, "RANGE_KEYS", 60)
    monkeypatch.setattr(P, "HOT", hot)
    monkeypatch.setattr(P, "RANGE_WORDS", 100)
    monkeypatch.setattr(P, "SHARD_WORDS", 200)
    rows = made_up(400, hot)
    docs = table(spark, rows).repartition(7)
    assert found_in(docs, 4) == brute(rows, 4)


def test_only_the_best_are_ranked(spark):
    rows = made_up()
    docs = P.collocations(table(spark, rows), 3)
    got = sorted(tuple(r) for r in P.best_of_each(docs, 7).collect())
    assert got == brute(rows, 3, top=7)


def test_odd_rows(spark):
    assert found_in(clashing(odd_documents(spark), "phrase", "a", "n", "a.b"), 2) == brute(
        [(r["lang"], r["text"]) for r in odd_documents(spark).collect()], 2
    )
    assert found_in(empty_documents(spark), 2) == []
    rows = [(None, None), ("en", ""), ("en", " .,\n")]
    assert found_in(table(spark, rows), 1) == []


def pairs_in(line):
    often = np.zeros(len(line), bool)
    often[P.followed(line)] = True
    return often


def test_transducers():
    rng = np.random.default_rng(5)
    lines = [np.append(rng.integers(0, 6, 400), 0) for _ in range(3)]
    want = Counter()
    for line in lines:
        for i in range(len(line)):
            for k in (2, 3, 4):
                gram = tuple(line[i : i + k].tolist())
                if len(gram) == k and 0 not in gram:
                    want[gram] += 1
    shards = []
    for line in lines:
        shards.append([[*columns, counts] for columns, counts in P.sorted_phrases(line, pairs_in(line))])
    whole = P.CountTransducer.union(shards)
    got = {g: n for columns, ns in whole.phrases() for *g, n in zip(*(c.tolist() for c in columns), ns.tolist(), strict=True) for g in [tuple(g)]}
    assert got == dict(want)
    for least in (1, 2, 5, 10**6):
        tree = whole.pruned(least)
        small = P.CountTransducer.unpacked(tree.minimal().packed())
        assert sum(map(len, small.arcs)) <= sum(map(len, tree.arcs))
        for k in (2, 3, 4):
            asked = [rng.integers(1, 7, 300) for _ in range(k)]
            found = small.compose(asked).tolist()
            real = [want[tuple(int(c[i]) for c in asked)] for i in range(300)]
            assert found == [n if n >= least else 0 for n in real]


def test_minimal_automata_share_futures():
    """Two words with the same followers and counts lead to one state."""
    line = np.array([1, 3, 4, 0, 2, 3, 4, 0])
    tree = P.CountTransducer.union([[[*c, n] for c, n in P.sorted_phrases(line, pairs_in(line))]])
    small = tree.minimal()
    assert [len(a) for a in tree.arcs[:3]] == [3, 3, 2]
    assert [len(a) for a in small.arcs[:3]] == [3, 2, 1]


def test_exact_beyond_64_bits(spark):
    big = 9 * 10**15
    found = spark.createDataFrame([([2, 4], big)], "phrase array<long>, a long")
    counts = spark.createDataFrame([([2], big), ([4], big + 1)], "phrase array<long>, f long")
    row = P.scored(found, counts).first()
    assert row["score"] == 2_000_000 * big // (2 * big + 1)


@pytest.mark.parametrize("fan,keys", [(2, 20), (3, 1000), (256, 50)])
def test_totals(spark, monkeypatch, fan, keys):
    """Each sender is told the sums for its keys, in its order, in one round or several; rows grow with the senders."""
    monkeypatch.setattr(totals, "FAN", fan)
    monkeypatch.setattr(totals, "RANGE_KEYS", keys)
    rng = np.random.default_rng(fan)
    known = np.sort(rng.integers(0, 2**64, 300, dtype=np.uint64))
    want, senders = Counter(), {}
    for s in range(13):
        mine = np.unique(rng.choice(known, int(rng.integers(0, 120))))
        counts = rng.integers(0, 9, len(mine)).astype(np.uint64)
        senders[f"s{s}"] = (mine, counts)
        for k, c in zip(mine.tolist(), counts.tolist(), strict=True):
            want[k] += c
    rows = [(s, bytearray(totals.pack_sorted(k)), bytearray(totals.pack(c))) for s, (k, c) in senders.items()]
    asked = spark.createDataFrame(rows, "sender string, keys binary, counts binary")
    told = totals.totals(asked, len(rows), 300, "test").toPandas()
    assert told.groupby("sender").size().max() <= fan
    for s, (mine, _) in senders.items():
        assert totals.joined(told[told["sender"] == s]).tolist() == [want[k] for k in mine.tolist()]
