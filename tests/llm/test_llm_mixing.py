from __future__ import annotations

import random

import pytest
from llm_cases import ODD, clashing, empty_documents, given, odd_documents
from pyspark.sql import functions as F

from shoplake.llm import mixing as M
from shoplake.llm.common import running
from shoplake.llm.queries import SCHEDULES


def shared(sizes, weights, budget, times=3):
    """Targets by resharing until none is above."""
    full = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        rest = budget - sum(times * sizes[i] for i in full)
        level = rest / sum(weights[i] for i in free) if free else 0
        above = {i for i in free if level * weights[i] > times * sizes[i]}
        if not above:
            return [times * s if i in full else level * weights[i] for i, s in enumerate(sizes)]
        full |= above


def test_targets(spark):
    rng = random.Random(4)
    for _ in range(8):
        sizes = [rng.choice([0, 1, 5, 100, 4000]) for _ in range(rng.randint(1, 9))]
        weights = [float(rng.choice([5, 2, 1])) for _ in sizes]
        rows = list(zip(range(len(sizes)), sizes, weights, strict=True))
        sources = spark.createDataFrame(rows, "k int, source_size long, weight double")
        told = M.targets(sources, sum(sizes)).orderBy("k").collect()
        assert [r["target"] for r in told] == pytest.approx(shared(sizes, weights, sum(sizes)))


def integral(schedule, until, steps=20_000):
    def weight(t):
        for (p, w), (q, v) in zip(schedule, schedule[1:], strict=False):
            if t <= q:
                return w + (v - w) * (t - p) / (q - p)
        return 0.0

    return sum(weight((k + 0.5) * until / steps) for k in range(steps)) * until / steps


@pytest.mark.parametrize(
    "schedule", [*SCHEDULES, ((0, 0.0), (0.25, 4.0), (0.5, 0.0), (1, 1.0)), ((0, 1.0), (0.5, 0.0), (0.75, 0.0), (1, 3.0))]
)
def test_position_inverts_the_integral(spark, schedule):
    whole = integral(schedule, 1.0)
    assert M.weight_of(schedule) == pytest.approx(whole, rel=1e-4)
    shares = [0.0, 0.01, 0.2, 0.5, 0.77, 0.999, 1.0]
    rows = spark.createDataFrame([(s,) for s in shares], "share double")
    for r in rows.select("share", M.position(F.col("share"), schedule).alias("at")).collect():
        assert 0 <= r["at"] <= 1
        assert integral(schedule, r["at"]) / whole == pytest.approx(r["share"], abs=2e-3)
    with pytest.raises(ValueError):
        M.checked(((0, 1.0), (0.5, 1.0)))


def mixed(docs, **settings):
    sized = docs.withColumn("size", M.words_in("text")).drop("text")
    return M.mix(sized, SCHEDULES, **settings)


def test_laws(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01")
    rows = mixed(docs).collect()
    assert len(rows) == docs.count()
    by_source = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum(t["words"] for t in r["takes"])
        by_source.setdefault(r["source"], []).append(r)
    for found in by_source.values():
        assert found[0]["source_size"] == sum(r["size"] for r in found)
        assert sum(r["taken"] for r in found) == round(found[0]["target"])
    again = mixed(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_order_follows_the_schedules(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01").withColumn("source", F.expr("'s' || doc_id % 3"))
    told = mixed(docs)
    targets = {r["source"]: r["target"] for r in told.select("source", "target").distinct().collect()}
    rows = M.in_order(told).where("words > 0").orderBy("at").collect()
    at, before, total = 0, dict.fromkeys(targets, 0), sum(targets.values())
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    for r in rows:
        assert r["at"] == at
        at += r["words"]
        before[r["source"]] += r["words"]
        if r["position"] < 0.5:
            half = dict(before)
    assert at == pytest.approx(total, abs=2)
    for k, s in enumerate(sorted(targets)):
        assert half[s] / targets[s] == pytest.approx(integral(SCHEDULES[k], 0.5) / integral(SCHEDULES[k], 1), abs=0.05)


def test_one_source_of_one_document(spark):
    docs = spark.createDataFrame([(1, "a b c", None)] * 5 + [(2, "x " * 40, "s")], "doc_id long, text string, source string")
    rows = mixed(docs).collect()
    assert sum(r["taken"] for r in rows if r["source"] is None) == round(rows[0]["target"]) or rows[0]["source"] == "s"
    by = {r["source"]: r for r in rows}
    assert by["s"]["target"] == pytest.approx(55 * 5 / 7) and by[None]["target"] == pytest.approx(55 * 2 / 7)
    assert sum(r["taken"] for r in rows) == 39 + 16


def test_odd_rows(spark):
    docs = clashing(odd_documents(spark), "Target", "taken", "kind_", "before_", "a.b", "one", "all")
    rows = mixed(docs).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["size"] == len((next(o for o in ODD if o[0] == r["doc_id"])[1] or "").split()) or r["doc_id"] is None
    assert M.in_order(mixed(docs)).count() >= len(ODD)
    assert mixed(empty_documents(spark)).collect() == []
    assert M.in_order(mixed(empty_documents(spark))).collect() == []
    silent = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixed(silent).collect()] == [(0, 0.0)] * 2


def test_running_sums_split_repeated_rows(spark):
    """Equal rows lie in several ranges and still get gapless places."""
    rows = spark.range(4000).select((F.col("id") % 2).alias("g"), F.lit("same").alias("x"), F.lit(2).cast("long").alias("n"))
    told = running(rows, "g", ["x"], "n", "before", "total")
    assert told.rdd.getNumPartitions() >= 1
    for g in (0, 1):
        found = sorted(r["before"] for r in told.where(F.col("g") == g).collect())
        assert found == list(range(0, 4000, 2))
    assert {r["total"] for r in told.collect()} == {4000}
