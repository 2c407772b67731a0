"""Quality rules: a decision list learned by sequential covering, applied as SQL conditions.

Statistics of a text are built-in expressions over its words and lines; nothing is exploded or
shuffled. From the statistics of labelled documents, rules (conjunctions of thresholds) for bad
documents are grown one condition at a time on two thirds of the rows, pruned on the other third,
and their documents are removed before the next rule is sought. What comes out is an ordered
list that reads like ``n_symbols / n_words >= 0.41 -> drop`` and runs as one conditional expression.

The learner takes at most ``LEARN_ROWS`` different labelled rows, picked by hashes of their ids and statistics;
that bound is a parameter. Everything else covers all rows.

Defined results: NULL and empty texts have no words and fail the base rule; ratios of texts without
words are 0; without labels of both kinds no rule is learned and only the base rule drops;
repeated rows are judged alike and teach once; an id whose labels disagree teaches nothing. Other columns are
kept unless a result has the same name. Windows are compared by a 64-bit hash of their eight words.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import join_small, named, stored
from shoplake.llm.secret_scan import let

#: Most labelled rows the driver learns from; see ``labelled_sample``.
LEARN_ROWS = 20_000
#: Thresholds tried for a statistic.
CUTS = 40
MOST_RULES, MOST_CONDITIONS = 16, 4
#: A rule must be right this often, in the rows it is grown from and in those it is tested on.
PRECISION = 0.95

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct_words n_upper n_marks "
    "n_chars_all"
).split()

#: Statistic -> (counted, per what).
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_share": ("n_upper", "n_chars_all"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}
STATISTICS = ["n_words", *RATIOS]


def size(array: Column) -> Column:
    return F.size(array).cast("long")


def left_over(text: Column, dropped: str) -> Column:
    """How many characters remain when a pattern is taken out."""
    return F.length(F.regexp_replace(text, dropped, "")).cast("long")


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """How many words lie in windows of ``n`` that occur at least twice, first ones included.

    Only texts whose windows are not all different are sorted. Equal windows are neighbours
    then; a word belongs to the last repeated window that begins at or before it.
    """

    def placed(windows: Column) -> Column:
        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def twice(pairs: Column) -> Column:
            last = F.size(pairs) - 1
            found = F.filter(
                pairs,
                lambda p, k: ((k > 0) & (pairs[F.greatest(k - 1, F.lit(0))]["h"] == p["h"]))
                | ((k < last) & (pairs[F.least(k + 1, last)]["h"] == p["h"])),
            )
            return let(F.sort_array(F.transform(found, lambda p: p["i"])), covered)

        def covered(starts: Column) -> Column:
            last = F.size(starts) - 1
            new = F.transform(
                starts,
                lambda s, k: F.when(k < last, F.least(F.lit(n), starts[F.least(k + 1, last)] - s)).otherwise(n),
            )
            return F.aggregate(new, F.lit(0).cast("long"), lambda total, x: total + x)

        all_differ = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(all_differ, F.lit(0).cast("long")).otherwise(let(F.sort_array(pairs), twice))

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n))
    )
    return F.when(F.size(words) > n, let(hashes, placed)).otherwise(F.lit(0).cast("long"))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counted statistics (COUNTS) of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))

    def counts(words: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            lines,
            lambda lines: F.struct(
                size(words).alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                left_over(t, r"[^#*$%&|<>]+").alias("n_symbols"),
                (size(lines) - size(F.array_distinct(lines))).alias("n_dup_lines"),
                repeated_words(words).alias("n_repeat_words"),
                size(lines).alias("n_lines"),
                size(F.array_distinct(words)).alias("n_distinct_words"),
                left_over(t, r"\P{Lu}+").alias("n_upper"),
                left_over(t, r"[^!?]+").alias("n_marks"),
                F.length(t).cast("long").alias("n_chars_all"),
            ),
        )

    words = F.array_remove(F.split(t, SPACE), "")
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in {*COUNTS, "counted"}]
    counted = docs.select(*kept, let(words, counts).alias("counted"))
    return counted.select(*kept, "counted.*")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def statistic(name: str) -> Column:
    if name not in RATIOS:
        return F.col(name).cast("double")
    part, whole = RATIOS[name]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = statistic(self.name)
        return value >= self.cut if self.above else value < self.cut

    def rows(self, values: np.ndarray) -> np.ndarray:
        column = values[:, STATISTICS.index(self.name)]
        return column >= self.cut if self.above else column < self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.cut:.4g}"


Rule = tuple[Condition, ...]


def covers(rule: Sequence[Condition], values: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, [c.rows(values) for c in rule], np.ones(len(values), bool))


def candidates(values: np.ndarray) -> list[Condition]:
    """Thresholds in the middle between neighbouring quantiles that differ."""
    found = []
    for k, name in enumerate(STATISTICS):
        points = np.unique(np.quantile(values[:, k], np.linspace(0, 1, CUTS + 1)))
        for cut in ((points[1:] + points[:-1]) / 2).tolist():
            found += [Condition(name, True, cut), Condition(name, False, cut)]
    return found


def grow(values: np.ndarray, bad: np.ndarray) -> Rule:
    """Add the condition with the highest information gain until only bad rows are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(values), bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        before = math.log2(p0 / (p0 + n0))
        best, gain = None, 1e-9
        for c in candidates(values[inside & bad]) + candidates(values[inside]):
            held = inside & c.rows(values)
            p, n = (held & bad).sum(), (held & ~bad).sum()
            if p and p * (math.log2(p / (p + n)) - before) > gain:
                best, gain = c, p * (math.log2(p / (p + n)) - before)
        if best is None:
            break
        rule.append(best)
        inside &= best.rows(values)
    return tuple(rule)


def prune(rule: Rule, values: np.ndarray, bad: np.ndarray) -> Rule:
    """Drop last conditions as long as that is no worse on rows the rule wasn't grown from."""

    def worth(part: Rule) -> float:
        held = covers(part, values)
        p, n = (held & bad).sum(), (held & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    parts = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (worth(part), -len(part)))


def learn(values: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """The ordered rules for bad rows; anything that no rule covers is kept."""
    rules: list[Rule] = []
    test = np.arange(len(values)) % 3 == 2
    left = np.ones(len(values), bool)
    while len(rules) < MOST_RULES and (left & bad & ~test).sum() >= 2:
        g, t = left & ~test, left & test
        rule = grow(values[g], bad[g])
        if not rule:
            break
        rule = prune(rule, values[t], bad[t])
        held = covers(rule, values) & left
        precise = [
            (held & part & bad).sum() >= PRECISION * (held & part).sum() for part in (g, t)
        ]
        if not all(precise) or (held & bad).sum() < 2:
            break
        rules.append(rule)
        left &= ~held
    return rules


def hashed_share(share: float, *columns: str) -> Column:
    """Whether a hash of the columns falls into this share of all hashes."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(share * (1 << 30))


def labelled_sample(
    counted: DataFrame, labels: DataFrame, doc_id: str, label: str, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and badness (label 0) of at most ``rows`` labelled rows, in the order of a hash.

    Ids are picked first, so that only their rows are joined. Equal rows count as one. An id that very many different rows
    share brings a share of them, and no id brings more than ``rows`` to the driver.
    """
    bad = F.col(named(label)) == 0
    known = labels.where(bad.isNotNull() & F.col(named(doc_id)).isNotNull())
    marked = known.groupBy(F.col(named(doc_id)).alias("labelled_id")).agg(
        F.min(bad).alias("bad"), F.max(bad).alias("also")
    )
    marked = stored(marked.where(F.col("bad") == F.col("also")).drop("also"), "labels")
    share = min(1.0, rows / max(1, marked.count()))
    picked = stored(marked.where(hashed_share(share, "labelled_id")), "picked")
    asked = counted.select(
        F.col(named(doc_id)).alias("labelled_id"), *[statistic(s).alias(s) for s in STATISTICS]
    )
    key = ["labelled_id", *STATISTICS]
    taught = stored(join_small(asked, picked, ["labelled_id"], "inner").select(*key, "bad").distinct(), "taught")
    # somewhat more than are asked for, so that few rows are sorted
    share = min(1.0, 1.2 * rows / max(1, taught.count()))
    least = taught.where(hashed_share(share, *key)).select(F.xxhash64(*key).alias("h"), "bad", *STATISTICS)
    found = least.orderBy("h", "bad", *STATISTICS).limit(rows).collect()
    values = np.array([r[2:] for r in found], float).reshape(len(found), len(STATISTICS))
    return values, np.array([r["bad"] for r in found], bool)


def learn_rules(
    counted: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    label: str = "quality",
    rows: int = LEARN_ROWS,
) -> list[Rule]:
    return learn(*labelled_sample(counted, labels, doc_id, label, rows))


def dropping_rule(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that covers a row, from 1; NULL if none does."""
    found = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        found = F.when(reduce(lambda a, b: a & b, [c.column() for c in rule]), k).otherwise(found)
    return found


def judged(counted: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds base_failed, dropped_by (number of the rule) and kept."""
    out = counted.withColumn("base_failed", base_failed())
    out = out.withColumn("dropped_by", dropping_rule(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("dropped_by").isNull())
