from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD, PROSE, clashing, empty_documents, given, odd_documents

from shoplake.llm import jaccard as J
from shoplake.llm.components import components


def brute(rows):
    """(id, least id of the class, links) of each (id, text), by comparing all pairs."""
    sets = [set(J.gram_sets([t], 5)[0].tolist()) for _, t in rows]
    part, links = list(range(len(rows))), [0] * len(rows)

    def top(k):
        while part[k] != k:
            k = part[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links[i] += 1
                links[j] += 1
                part[top(i)] = top(j)
    members = {}
    for k, (doc_id, _) in enumerate(rows):
        members.setdefault(top(k), []).append(doc_id)
    least = {k: min((x for x in ids if x is not None), default=None) for k, ids in members.items()}
    return Counter((rows[k][0], least[top(k)], links[k]) for k in range(len(rows)))


def told(df):
    return Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect())


def near_copies(n, seed=1):
    """One text in many versions, each with its own changes: all different, most of them similar."""
    dice = random.Random(seed)
    words = [f"w{dice.randrange(400)}" for _ in range(260)]
    out = []
    for k in range(n):
        mine = list(words)
        for _ in range(dice.randint(0, 5)):
            mine[dice.randrange(len(mine))] = f"x{dice.randrange(9)}"
        out.append((k + 1000, " ".join(mine)))
    return out


def test_bands_reach_the_recall():
    bands, rows = J.plan_bands(0.8, 0.9995)
    assert (bands, rows) == (20, 5)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995
    assert J.plan_bands(0.5, 0.99)[1] < rows


def test_bands_agree_as_often_as_sets_do():
    dice = np.random.Generator(np.random.Philox(3))
    same = []
    for _ in range(200):
        both = dice.integers(0, 1 << 63, 100, dtype=np.uint64)
        mine, yours = (
            np.unique(np.append(both, dice.integers(0, 1 << 63, 50, dtype=np.uint64))) for _ in "ab"
        )
        values = J.band_values([mine, yours], 40, 1)
        same.append((values[0] == values[1]).mean())
    assert np.mean(same) == pytest.approx(0.5, abs=0.03)  # Jaccard 100 / 200


def test_similar_is_exact(monkeypatch):
    monkeypatch.setattr(J, "MATRIX_BYTES", 4096)  # many column blocks
    dice = np.random.Generator(np.random.Philox(8))
    sets = [np.unique(dice.integers(0, 60, dice.integers(1, 80)).astype(np.uint64)) for _ in range(40)]
    found = J.similar(sets[:25], sets, 0.6)
    for i in range(25):
        for j in range(40):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert found[i, j] == (len(a & b) >= 0.6 * len(a | b))


@pytest.mark.parametrize("chunk", [512, 7])
def test_given_documents_and_a_large_group(spark, monkeypatch, chunk):
    """With small chunks, groups are dealt to pairs of chunks; nothing may change."""
    monkeypatch.setattr(J, "CHUNK", chunk)
    docs = given(spark, "documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(near_copies(60), docs.schema))
    rows = [tuple(r) for r in docs.collect()]
    assert told(J.classes(docs)) == brute(rows)


def test_odd_rows(spark):
    docs = clashing(odd_documents(spark), "set_key", "class_id")
    want = brute([(r[0], r[1]) for r in ODD])
    got = told(J.classes(docs))
    wordless = Counter({k: n for k, n in want.items() if k[2] == 0})
    assert {k: n for k, n in got.items() if k[2]} == {k: n for k, n in want.items() if k[2]}
    assert got.total() == len(ODD) and sum(n for k, n in got.items() if not k[2]) == wordless.total()
    assert J.classes(empty_documents(spark)).collect() == []


def test_one_of_each(spark):
    kept = [(r["doc_id"], r["text"]) for r in J.one_of_each(odd_documents(spark)).collect()]
    ids = Counter(k for k, _ in kept)
    assert ids == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 1, 9: 1, None: 2}
    assert (None, "a row without an id") in kept and (None, None) in kept
    assert J.one_of_each(empty_documents(spark)).collect() == []


def test_one_of_each_without_repeated_ids(spark):
    docs = given(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {i for i, least, _ in brute(rows) if i == least}
    assert {r["doc_id"] for r in J.one_of_each(docs).collect()} == want


def test_components_of_chains_and_stars(spark):
    dice = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(200, 201), (3, 3)]
    edges += [(dice.randrange(300, 330), dice.randrange(300, 330)) for _ in range(20)]
    part = {k: k for e in edges for k in e}

    def top(k):
        while part[k] != k:
            k = part[k]
        return k

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        part[high] = low
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    tied = {k for a, b in edges if a != b for k in (a, b)}
    assert sorted((r["node"], r["root"]) for r in found) == sorted((k, top(k)) for k in tied)


def test_groups_stay_small_as_a_bucket_grows(spark, monkeypatch):
    """Bins are counted after members of a bucket are copied, and by the n-grams that they have."""
    monkeypatch.setattr(J, "CHUNK", 5)
    monkeypatch.setattr(J, "BIN_ROWS", 50)
    monkeypatch.setattr(J, "BIN_BYTES", 200_000)
    asked = []
    plain = J.binned
    monkeypatch.setattr(J, "binned", lambda rows, bins: asked.append((rows, bins)) or plain(rows, bins))
    rows = [*near_copies(40), *((k, f"a short text with number {k} in it") for k in range(400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(J.classes(docs)) == brute(rows)
    (dealt, dealt_bins), (needs, needs_bins) = asked
    assert dealt.count() <= dealt_bins * J.BIN_ROWS
    assert needs.agg({"n_grams": "sum"}).first()[0] * 8 <= needs_bins * J.BIN_BYTES
    assert needs_bins > needs.count() * (8 * 20 + 300) / J.BIN_BYTES  # long texts have more than the mean


def close_copies(n):
    """Different texts with one or two changes each, at places of their own."""
    words = [f"w{k}" for k in range(400)]
    out = []
    for k in range(n):
        mine = list(words)
        for place in {7 * k % 400, 31 * k % 400}:
            mine[place] = f"x{k}"
        out.append((k, " ".join(mine)))
    return out


def test_a_bucket_of_near_copies_moves_in_proportion(spark, monkeypatch):
    """Four times the near copies of one text are four times the rows, not sixteen times; links stay exact."""
    monkeypatch.setattr(J, "CHUNK", 10)
    asked = []
    plain = J.binned
    monkeypatch.setattr(J, "binned", lambda rows, bins: asked.append(rows) or plain(rows, bins))
    dealt = {}
    for n in (100, 400):
        texts = [*close_copies(n), (n, close_copies(1)[0][1]), (n + 1, "a text of its own among all these copies")]
        asked.clear()
        found = J.classes(spark.createDataFrame(texts, "doc_id long, text string"))
        assert told(found) == brute(texts)
        dealt[n] = asked[0].count()
    assert dealt[400] <= 6 * max(dealt[100], 100)


def test_a_core_and_what_lies_around_it(spark, monkeypatch):
    """Two texts that share most words, and versions of each near and far: cores, and pairs across them."""
    monkeypatch.setattr(J, "CHUNK", 6)
    close = close_copies(40)
    other = [(k + 100, " ".join([*t.split()[:370], *(f"y{i}" for i in range(30))])) for k, t in close]
    texts = [*close, *other, *near_copies(30)]
    large = []
    plain = J.cores
    monkeypatch.setattr(J, "cores", lambda *a: large.append(plain(*a)) or large[-1])
    assert told(J.classes(spark.createDataFrame(texts, "doc_id long, text string"))) == brute(texts)
    assert large[0].select("unit").distinct().count() > 1


def test_wordless_rows_of_a_dropped_id_stay(spark):
    """Their id also has a near copy of a lesser id; rows without id stay beside them."""
    copy = " ".join(f"w{k}" for k in range(50))
    rows = [(1, copy), (2, copy), (2, "..."), (3, "other words"), (None, "!!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in J.one_of_each(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(1, copy), (2, "..."), (3, "other words"), (None, "!!")], key=repr)


def test_one_of_each_with_clashing_names(spark):
    """Repeated ids, and columns called like those that tell them apart."""
    names = "doc_id long, text string, _again string, _set string, _id string, class_key string, `a.b` string"
    rows = [(1, PROSE, *"abcde"), (1, PROSE, *"abcdf"), (2, PROSE, *"abcde"), (3, None, *"abcde"), (1, "", *"zzzzz")]
    docs = spark.createDataFrame(rows, names)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "", r["a.b"]) for r in kept.collect()) == [
        (1, "", "z"), (1, PROSE, "e"), (3, "", "e"),
    ]
