from __future__ import annotations

import numpy as np
import pytest
from llm_cases import ODD, clashing, empty_documents, given, odd_documents

from shoplake.llm import language as L


def test_counts_against_plain_python():
    texts = ["Ab, ça!", None, "", "a", "日本 x\U00010400"]
    which, grams, counts = L.count_ngrams(texts, 3)
    found = {}
    for w, g, c in zip(which.tolist(), grams.tolist(), counts.tolist(), strict=True):
        points = [(g >> s) & 0x1FFFFF for s in (42, 21, 0)]
        found.setdefault(w, {})["".join(chr(p) if p else "_" for p in points)] = c
    want = {}
    for k, text in enumerate(texts):
        line = "__" + "".join(c if c.isalpha() else "_" for c in (text or "").lower()) + "__"
        for i in range(1, len(line) - 1):
            if line[i] != "_":
                gram = line[i - 1 : i + 2]
                want.setdefault(k, {})[gram] = want.get(k, {}).get(gram, 0) + 1
    assert found == want


def test_ngram_vectors_bind_rotated_letters():
    space = L.Space(dims=64)
    a, b, c = (space.letter(ord(x)) for x in "abc")
    code = (ord("a") << 42) | (ord("b") << 21) | ord("c")
    bound = a * np.roll(b, 1) * np.roll(c, 2)
    assert (space.ngrams(np.array([code]))[0] == bound).all()
    assert set(bound.tolist()) <= {1.0, -1.0}


def test_prototypes_and_predictions_against_plain_sums(spark):
    space = L.Space(dims=128)
    docs = given(spark, "documents").limit(60)
    rows = docs.collect()
    found = L.learn_prototypes(docs, space=space)
    for lang in {r["lang"] for r in rows}:
        _, grams, counts = L.count_ngrams([r["text"] for r in rows if r["lang"] == lang], 3)
        assert np.allclose(found[lang], counts @ space.ngrams(grams).astype(float))
    names, away, mean = L.centred(found)
    for r in L.predict(docs, found, space=space).collect():
        _, grams, counts = L.count_ngrams([r["text"]], 3)
        bundle = counts @ space.ngrams(grams).astype(float)
        rest = bundle / np.linalg.norm(bundle) - mean
        cosines = away @ (rest / np.linalg.norm(rest))
        assert r["score"] == pytest.approx((1 + cosines.max()) / 2, abs=1e-4)
        assert cosines[names.index(r["lang_pred"])] == pytest.approx(cosines.max(), abs=1e-5)


def test_held_out_accuracy(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01")
    held_out = L.held_out_rows("doc_id")
    told = L.predict(docs.where(held_out), L.learn_prototypes(docs.where(~held_out))).collect()
    assert len(told) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in told) >= 0.98 * len(told)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    prototypes = L.learn_prototypes(given(spark, "documents"))
    told = L.predict(clashing(docs, "score", "LANG_PRED"), prototypes).collect()
    assert len(told) == len(ODD)
    for r in told:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and (letters or r["score"] == 0)
    assert len({(r["lang_pred"], r["score"]) for r in told if r["doc_id"] == 7}) == 1
    assert L.predict(empty_documents(spark), prototypes).collect() == []


def test_nothing_to_learn_from(spark):
    assert L.learn_prototypes(empty_documents(spark)) == {}
    told = L.predict(odd_documents(spark), {}).collect()
    assert {(r["lang_pred"], r["score"]) for r in told} == {("und", 0.0)}


def test_held_out_rows_do_not_teach(spark):
    import zlib

    docs = given(spark, "documents").withColumn("h", L.held_out_rows("doc_id"))
    for r in docs.collect():
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_many_different_ngrams_are_added_in_pieces(spark, monkeypatch):
    """As for scripts with thousands of letters; nothing changes."""
    docs = given(spark, "documents").limit(20).select("doc_id", "text")
    dice = np.random.Generator(np.random.Philox(2))
    many = "".join(chr(c) for c in dice.integers(0x4E00, 0x9FA5, 3000))
    texts = [r["text"] for r in docs.collect()] + [many, "", None]
    counted = L.count_ngrams(texts, 3)
    space = L.Space(dims=64)
    whole = dict(L.bundles(*counted, space))
    monkeypatch.setattr(L, "GRAMS_AT_ONCE", 100)
    parts = dict(L.bundles(*counted, space))
    assert whole.keys() == parts.keys() and len(whole) == 21
    for k, bundle in whole.items():
        assert np.allclose(bundle, parts[k])


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 3)
    with pytest.raises(ValueError, match="languages"):
        L.learn_prototypes(given(spark, "documents"))
