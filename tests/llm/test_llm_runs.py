from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import DATA, LONG, ODD, clashing, empty_documents, given, odd_documents

from shoplake.llm import runs as R
from shoplake.llm.queries import op11_periodic_runs


def brute_runs(words, least=24, times=3):
    """All stretches with a period, word by word."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(
                all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q)
            )
            if length >= max(least, times * q) and not smaller:
                found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_up(rng):
    n, kinds = rng.randint(0, 110), rng.choice([1, 2, 3, 30])
    words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.7:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words + words[::-1] if rng.random() < 0.3 else words


@pytest.mark.parametrize("least,times", [(24, 3), (4, 2), (9, 4)])
def test_against_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(250):
        documents = [made_up(rng) for _ in range(rng.randint(1, 4))]
        got = R.runs_of(documents, least, times, tree_words=rng.choice([10, 1000]))
        assert got == [brute_runs(d, least, times) for d in documents]


def test_trees_extensions_and_lyndon_words():
    rng = random.Random(1)
    for _ in range(60):
        line = [rng.randrange(1, 4) for _ in range(rng.randint(1, 40))] + [0]
        n = len(line)
        tree = R.SuffixTree(line)
        right = R.Extensions(*tree.tour(np.arange(4)))
        assert right.rank.tolist() == R.ranks(np.array(sorted(range(n), key=lambda i: line[i:]))).tolist()
        turned = [0 if x == 0 else 4 - x for x in line]
        down = tree.suffixes(np.array([0, 3, 2, 1]))
        assert down.tolist() == sorted(range(n), key=lambda i: turned[i:])
        for i in range(n):
            for j in set(range(n)) - {i}:
                k = 0
                while max(i, j) + k < n and line[i + k] == line[j + k]:
                    k += 1
                assert right(np.array([i]), np.array([j]))[0] == k
        lengths = R.lyndon_lengths(right.rank)
        for i in range(n - 1):
            lyndon = [j - i for j in range(i + 1, n) if all(line[i:j] < line[k:j] for k in range(i + 1, j))]
            assert lengths[i] == max(lyndon)


def test_odd_rows(spark):
    docs = clashing(odd_documents(spark), "Runs", "n_runs", "a.b", "text_", "id_")
    found = R.find_runs(docs).collect()
    assert len(found) == len(ODD) and found[0]["a.b"] == "clash"
    for r in found:
        words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(words)
        if r["text"] != LONG:
            assert (r["n_runs"], r["runs"]) == (0, [])
            assert r["collapsed"] == b" ".join(words).decode()
    assert R.find_runs(empty_documents(spark)).collect() == []


def test_long_text_of_one_period(spark):
    docs = spark.createDataFrame([(1, "a b c " * 40_000), (2, "x " * 23), (3, "x " * 24)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in R.find_runs(docs).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 120_000, 3)] and found[1]["collapsed"] == "a b c"
    assert found[2]["n_runs"] == 0 and [tuple(r) for r in found[3]["runs"]] == [(0, 24, 1)]


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in op11_periodic_runs(spark, DATA).collect()}
    n_found = 0
    for doc in given(spark, "documents").collect():
        words = (doc["text"] or "").encode().split()
        h = zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500 and h % 10:
            continue  # too slow by brute force; all lengths are among the others
        want = brute_runs(words)
        r = rows[doc["doc_id"]]
        n_found += len(want)
        assert r["n_runs"] == len(want)
        told = "".join(f"{s},{length},{q}\n" for s, length, q in want)
        assert r["runs_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        dropped = {i for s, length, q in want for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        assert r["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
        if want:
            s, length, q = max(want, key=lambda x: (x[1] / x[2], -x[0], -x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, length, q, 1000 * length // q)
        else:
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (None,) * 4
    assert n_found > 5
