from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import LONG, ODD, clashing, empty_documents, given, odd_documents

from shoplake.llm import quality as Q
from shoplake.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(hit)


def random_texts(n):
    dice = random.Random(7)
    out = []
    for _ in range(n):
        words = dice.choices(["a", "b", "c#", "d", "😀é", "ff"], k=dice.randint(0, 60))
        words += words[: dice.choice([0, 3, 12])]
        out.append("".join(w + dice.choice([" ", " ", "\n", "\t \x0b", "\n\n"]) for w in words))
    return out


def test_counts_against_brute_force(spark):
    texts = random_texts(300) + [r[1] for r in ODD] + [LONG + " " + LONG]
    texts += [r["text"] for r in given(spark, "documents").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in Q.with_counts(docs).collect():
        assert tuple(r[c] for c in Q.COUNTS[:5]) == brute(r["text"]), r["doc_id"]


def test_no_python_in_the_plan(spark):
    plan = Q.with_counts(given(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_learns_a_planted_rule():
    dice = np.random.Generator(np.random.Philox(1))
    values = dice.random((3000, len(Q.STATISTICS)))
    a, b = (Q.STATISTICS.index(c) for c in ("symbols_per_word", "upper_share"))
    bad = ((values[:, a] > 0.8) & (values[:, b] > 0.5)) | (values[:, 0] < 0.05)
    rules = Q.learn(values, bad)
    dropped = np.logical_or.reduce([Q.covers(r, values) for r in rules])
    assert (dropped == bad).mean() > 0.97
    assert (dropped & ~bad).sum() <= 0.05 * dropped.sum()


@pytest.mark.parametrize("bad", [np.zeros(50, bool), np.ones(50, bool)])
def test_labels_of_one_kind(bad):
    values = np.random.Generator(np.random.Philox(1)).random((50, len(Q.STATISTICS)))
    assert Q.learn(values, bad) == []


def test_conditions_are_the_rules(spark):
    """The SQL conditions choose the rows that the learner's rules cover."""
    folder = "/root/testdata/sf0.01"
    counted = stored(Q.with_counts(given(spark, "documents", folder)), "test")
    labels = given(spark, "labels", folder)
    rules = Q.learn_rules(counted, labels)
    assert rules
    names = [Q.statistic(s).alias(f"s{i}") for i, s in enumerate(Q.STATISTICS)]
    rows = Q.judged(counted, rules).select("base_failed", "dropped_by", "kept", *names).collect()
    values = np.array([r[3:] for r in rows], float)
    first = np.zeros(len(rows), int)
    for k, rule in reversed(list(enumerate(rules, 1))):
        first[Q.covers(rule, values)] = k
    assert [r["dropped_by"] or 0 for r in rows] == first.tolist()
    for r in rows:
        assert r["kept"] == (not r["base_failed"] and r["dropped_by"] is None)
    told = Q.judged(counted, rules).join(labels, "doc_id").where("NOT base_failed").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in told)
    assert right >= 0.95 * len(told)


def test_odd_rows(spark):
    counted = Q.with_counts(clashing(odd_documents(spark), "n_words", "counted", "N_UPPER"))
    no_labels = given(spark, "labels").limit(0)
    rules = Q.learn_rules(counted, no_labels)
    assert rules == []
    found = Q.judged(counted, rules).collect()
    assert len(found) == len(ODD)
    for r in found:
        n = brute(r["text"])
        assert r["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert r["kept"] != r["base_failed"]
    repeated = spark.createDataFrame([(7, 0, 0), (7, 0, 0), (None, 1, 0), (5, None, 0)], no_labels.schema)
    values, bad = Q.labelled_sample(counted, repeated, "doc_id", "quality", 100)
    assert values.shape == (1, len(Q.STATISTICS)) and bad.tolist() == [True]
    assert Q.learn_rules(counted, repeated) == []
    disagreeing = spark.createDataFrame([(7, 0, 0), (7, 1, 0), (5, 1, 0)], no_labels.schema)
    assert Q.labelled_sample(counted, disagreeing, "doc_id", "quality", 100)[1].tolist() == [False]
    assert Q.judged(Q.with_counts(empty_documents(spark)), rules).collect() == []


def test_columns_called_like_those_of_the_sample(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = given(spark, "documents", folder), given(spark, "labels", folder)
    rules = Q.learn_rules(Q.with_counts(docs), labels)
    clash = Q.with_counts(clashing(docs, "bad", "labelled_id", "h", "symbols_per_word", "a.b"))
    assert rules and Q.learn_rules(clash, clashing(labels, "bad", "labelled_id", "also", "a.b")) == rules
    assert "a.b" in Q.judged(clash, rules).columns


@pytest.mark.parametrize("n_ids", [1, 3000])
def test_a_bounded_sample(spark, n_ids):
    """Whether one id has all the rows and labels, or each row an id of its own."""
    rows = [(k % n_ids, "word " * (k + 20)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k % n_ids, 0) for k in range(3000)], "doc_id long, quality int")
    counted = stored(Q.with_counts(docs), "test")
    for asked in (500, 2900, 5000):
        values, bad = Q.labelled_sample(counted, marks, "doc_id", "quality", asked)
        assert len(values) == len(bad) <= asked and bad.all()
        assert len(values) >= 0.85 * min(asked, 3000)
        assert len(np.unique(values, axis=0)) == len(values)
        again = Q.labelled_sample(counted.repartition(7), marks, "doc_id", "quality", asked)[0]
        assert (values == again).all()
