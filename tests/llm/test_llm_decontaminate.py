from __future__ import annotations

import random
import re

import pytest
from llm_cases import ODD, PROSE, ascii_lower, clashing, empty_documents, given, odd_documents

from shoplake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(ascii_lower(text))


def brute(doc, items, window):
    hit, found = [False] * len(doc), set()
    for name, item in items:
        if item:
            n = min(window, len(item))
            parts = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)}
            for i in range(len(doc) - n + 1):
                if tuple(doc[i : i + n]) in parts:
                    found.add(name)
                    hit[i : i + n] = [True] * n
    return sum(hit), found


def test_words_are_those_of_the_pattern():
    dice = random.Random(3)
    for _ in range(300):
        text = "".join(chr(dice.choice([dice.randrange(128), dice.randrange(0x2FF)])) for _ in range(60))
        assert [w.decode() for w in D.words_of(text)] == words(text)
        assert [m[0] for m in D.WORD.finditer(text)] == re.findall(
            r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text
        )


def test_automaton_against_brute_force():
    dice = random.Random(5)
    for _ in range(1500):
        letters = [b"a", b"b", b"c"][: dice.randint(1, 3)] + [b"d"] * dice.randint(0, 1)
        items = [
            (str(k), dice.choices(letters, k=dice.randint(0, 9))) for k in range(dice.randint(1, 5))
        ]
        window = dice.randint(1, 5)
        automaton = D.SuffixAutomaton(items, window)
        for _ in range(3):
            doc = dice.choices([*letters, b"z"], k=dice.randint(0, 20))
            spans, found = automaton.hits(doc)
            got = sum(b - a for a, b in spans), {automaton.names[k] for k in found}
            assert got == brute(doc, items, window)
            assert spans == D.merge(spans)


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 2000])
def test_given_tables(spark, block_bytes):
    """Also with many blocks of items, one automaton each."""
    docs, items = given(spark, "documents"), given(spark, "benchmark")
    held = [(str(r["item_id"]), words(r["text"])) for r in items.collect()]
    found = D.judged(D.match_items(docs, items, block_bytes=block_bytes)).collect()
    assert len(found) == docs.count()
    for r in found:
        doc = words(r["text"])
        n_hit, ids = brute(doc, held, 13)
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (len(doc), n_hit, sorted(ids))
        assert r["contaminated"] == (n_hit > 0 and 20 * n_hit >= len(doc))
    assert any(r["contaminated"] for r in found)


def test_odd_rows(spark):
    items = spark.createDataFrame(
        [
            (1, "on the mat and then it went out of the house into the garden to"),
            (1, "naïve strasse"),
            (None, "WITHOUT an id"),
            (2, None),
            (3, " ?"),
            (4, "NAÏVE"),
            (5, "naïve Straße"),
        ],
        "item_id long, text string",
    )
    docs = clashing(odd_documents(spark), "n_hit", "spans")
    found = D.judged(D.match_items(docs, items)).collect()
    assert len(found) == len(ODD)
    told = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert told[1]["n_words"] == told[2]["n_words"] == told[4]["n_hit"] == 0
    assert not told[1]["contaminated"]
    assert told[5]["item_ids"] == ["1"] and told[5]["n_hit"] == 15
    assert told[9]["item_ids"] == ["5"]  # only A-Z are lower-cased: NAÏVE is another word
    nameless = [r for r in found if r["doc_id"] is None and r["text"]]
    assert [r["item_ids"] for r in nameless] == [[""], [""]]
    nothing = items.limit(0)
    assert D.judged(D.match_items(docs, nothing)).where("n_hit > 0 OR contaminated").count() == 0
    assert D.match_items(empty_documents(spark), items).collect() == []


def test_spans_are_cut_and_clean_texts_stay(spark):
    items = spark.createDataFrame([(1, "of the house into the garden")], "item_id long, text string")
    filler = " ".join(f"filler{i}" for i in range(400))
    rows = [
        (1, "Of the house, into the GARDEN.", None, None, None),
        (2, f"{filler}. Of the house, into the GARDEN! End.", None, None, None),
        (3, PROSE.replace("garden", "yard"), None, None, None),
        (4, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, odd_documents(spark).schema)
    kept = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, items).collect()}
    assert kept == {2: f"{filler}. ! End.", 3: rows[2][1], 4: None}


def test_given_columns_stay_whatever_their_names(spark):
    rows = spark.createDataFrame(
        [(1, "clean words only", 7, True, "s", "x"), (2, ITEM_OF_CLASHES, 8, False, "s", "y")],
        "doc_id long, text string, n_items int, contaminated boolean, spans string, `a.b` string",
    )
    items = spark.createDataFrame([(5, ITEM_OF_CLASHES)], "item_id long, text string")
    kept = D.decontaminate(rows, items)
    assert kept.columns == rows.columns
    assert [tuple(r) for r in kept.collect()] == [(1, "clean words only", 7, True, "s", "x")]


ITEM_OF_CLASHES = " ".join(f"item{k}" for k in range(20))


def test_pieces_have_all_windows():
    dice = random.Random(11)
    for _ in range(500):
        item = [bytes([dice.choice(b"abc")]) * dice.choice([1, 1, 2, 90]) for _ in range(dice.randint(0, 60))]
        window, size = dice.randint(1, 13), dice.choice([1, 10, 40, 1000])
        pieces = list(D.cut_item(item, window, size))

        def windows(words, window=window):
            n = min(window, len(words))
            return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()

        assert set().union(*map(windows, pieces)) == windows(item)
        assert all(len(p) >= min(window, len(item)) for p in pieces)


@pytest.mark.parametrize("block_bytes", [4000, 8000])
def test_an_item_longer_than_a_block(spark, block_bytes):
    dice = random.Random(13)
    long_item = [f"w{dice.randrange(300)}" for _ in range(900)]
    held = [("1", long_item), ("2", long_item[100:400]), ("3", ["w1", "w2"]), ("4", long_item[5:20])]
    items = spark.createDataFrame([(n, " ".join(w)) for n, w in held], "item_id string, text string")
    rows = [(k, [f"w{dice.randrange(300)}" for _ in range(40)] + long_item[k * 20 : k * 20 + k + 5]) for k in range(40)]
    rows += [(40, long_item), (41, []), (42, ["w1", "w2"])]
    docs = spark.createDataFrame([(k, " ".join(w), 1) for k, w in rows], "doc_id long, text string, `a.b` int")
    found = D.match_items(docs, items, block_bytes=block_bytes)
    assert found.columns == [*docs.columns, "n_words", "n_hit", "spans", "item_ids"]
    told = {r["doc_id"]: r for r in found.collect()}
    assert len(told) == len(rows)
    for k, words_ in rows:
        n_hit, ids = brute(words_, held, 13)
        assert (told[k]["n_words"], told[k]["n_hit"], told[k]["item_ids"]) == (len(words_), n_hit, sorted(ids))
    kept = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, items, block_bytes=block_bytes).collect()}
    assert kept == {r["doc_id"]: r["text"] for r in D.decontaminate(docs, items).collect()}


def test_odd_rows_with_many_blocks(spark):
    words_ = [f"item {k} of many" for k in range(200)]
    items = spark.createDataFrame([(k, t) for k, t in enumerate([*words_, "naïve Straße", None])], "item_id long, text string")
    docs = clashing(odd_documents(spark), "row_", "n_hit")
    order = ["doc_id", "text", "n_words", "n_hit", "spans", "item_ids"]
    one, many = (
        sorted((tuple(r) for r in D.match_items(docs, items, block_bytes=b).select(*order).collect()), key=repr)
        for b in (D.BLOCK_BYTES, 6000)
    )
    assert one == many and len(one) == len(ODD)
    assert D.match_items(empty_documents(spark), items, block_bytes=6000).collect() == []
    assert "row_" in D.match_items(docs, items, block_bytes=6000).columns
