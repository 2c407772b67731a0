"""A training order that mixes sources by weights which change in the course of training.

Each source has a schedule: its weight as a line of straight pieces over the progress of training, from 0 to 1.

1. The integral of a schedule is the source's weight in the whole mix. The budget is shared by these weights;
   no source gets more than ``times`` its size, and the excess is shared again among the others until
   none is above (``targets``). Every round is one sum over the sources.
2. The documents of a source are put in a fixed order, by a hash of their id, and each gets the number of words
   before it. A source that is asked for more than it has is read again from its start; the last document
   is taken in part, so what is taken of a source is its target to the word.
3. A document's middle is a share of its source's whole demand. Inverting the integral of the schedule up to a
   progress gives the progress at which the source has been asked for that share: its position.
4. All takings are sorted by position in ranges, with the number of words before each (``in_order``).

Sources may have any share of the rows: sums run over ranges of rows (``common.running``), so no source meets
in one task, nor do repeated rows. Only the number of words and two sums over the sources reach the driver.

Words are what stands between blanks and the control characters 9 to 13. Defined results: NULL and empty texts
have no words and are not taken; a NULL source is a source, the last one; documents whose ids are NULL
or repeat are taken one by one, in the order of their other given columns; a mix of no words has targets of
zero. Columns are kept unless a result has the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import join_small, named, running, stored, unused

#: (progress, weight) of the corners, from progress 0 to 1.
Schedule = Sequence[tuple[float, float]]
#: Most times that a document is taken.
TIMES = 3
RESULTS = ("source_size", "target", "taken", "takes")


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(named(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def id_hash(doc_id: str) -> Column:
    return F.md5(F.coalesce(F.col(named(doc_id)).cast("string"), F.lit("")).cast("binary"))


def checked(schedule: Schedule) -> Schedule:
    progress, weights = [p for p, _ in schedule], [w for _, w in schedule]
    if len(schedule) < 2 or (progress[0], progress[-1]) != (0, 1) or sorted(set(progress)) != progress:
        raise ValueError("a schedule has rising corners from 0 to 1")
    if min(weights) < 0 or not max(weights) > 0:
        raise ValueError("weights must be zero or more, and one above")
    return schedule


def pieces(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """(integral before, integral after, progress, weight, slope) of each straight piece."""
    out, before = [], 0.0
    for (p, w), (q, v) in zip(schedule, schedule[1:], strict=False):
        after = before + (q - p) * (w + v) / 2
        out.append((before, after, p, w, (v - w) / (q - p)))
        before = after
    return out


def weight_of(schedule: Schedule) -> float:
    return pieces(schedule)[-1][1]


def position(share: Column, schedule: Schedule) -> Column:
    """The progress at which the schedule's integral has reached a share of its whole.

    Within a piece the integral is a parabola; the root is written so that it holds for level pieces as well.
    """
    whole = weight_of(schedule)
    out = F.lit(1.0)
    for before, after, p, w, slope in reversed(pieces(schedule)):
        rest = F.greatest(share * F.lit(whole) - F.lit(before), F.lit(0.0))
        below = F.lit(w) + F.sqrt(F.greatest(F.lit(w * w) + F.lit(2 * slope) * rest, F.lit(0.0)))
        at = F.lit(p) + F.when(rest > 0, F.lit(2.0) * rest / below).otherwise(F.lit(0.0))
        out = F.when(share * F.lit(whole) < F.lit(after), at).otherwise(out)
    return F.least(out, F.lit(1.0))


def targets(sources: DataFrame, budget: float, times: int = TIMES) -> DataFrame:
    """Adds target to a stored table with weight and source_size: shares of the budget by weight, none above
    ``times`` its source's size."""
    most = F.col("source_size") * F.lit(float(times))
    level, held = None, -1
    while True:
        above = F.lit(False) if level is None else most < F.col("weight") * F.lit(level)
        told = sources.agg(
            F.count_if(above).alias("held"),
            F.sum(F.when(above, most)).alias("full"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if level is not None and told["held"] == held:
            break
        held = told["held"]
        if not told["free"]:
            break
        level = (budget - (told["full"] or 0.0)) / told["free"]
    return sources.withColumn("target", F.least(most, F.col("weight") * F.lit(level or 0.0)))


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    times: int = TIMES,
    share: float = 1.0,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
) -> DataFrame:
    """Adds source_size, target, taken and takes, an array of (number, words, position) for each time that the
    document is taken. ``size`` has its words. The sources, in order, have the schedules in turn; ``share``
    of all words is the size of the mix. What is not needed should be left out of ``docs``: all its columns
    are shuffled.
    """
    schedules = [checked(s) for s in schedules]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in RESULTS])
    kind, turn, key, before = (unused(docs.columns, n) for n in ("kind_", "turn_", "source_", "before_"))
    docs = stored(docs, "sized")
    sums = docs.groupBy(F.col(named(source)).alias(key)).agg(F.sum(named(size)).cast("long").alias("source_size"))
    each = sums.withColumns({"one": F.lit(1).cast("long"), "all": F.lit(0).cast("long")})
    numbered = running(each, "all", [F.col(key).isNull(), key], "one", kind, "sources")
    step = F.pmod(F.col(kind), F.lit(len(schedules)))
    weight = F.element_at(F.array(*[F.lit(weight_of(s)) for s in schedules]), (step + 1).cast("int"))
    sources = stored(numbered.select(key, kind, "source_size", weight.cast("double").alias("weight")), "sources")
    budget = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    aims = stored(targets(sources, budget, times).select(key, kind, "source_size", "target"), "targets")
    # one name for the NULL source, so that the join is by equal values
    name = F.coalesce(F.concat(F.lit("="), F.col(named(source)).cast("string")), F.lit(""))
    marked = docs.withColumn(turn, name)
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    aims = aims.withColumn(turn, name).drop(key)
    aimed = join_small(marked, stored(aims, "aims"), [turn], "inner").drop(turn)
    order = [id_hash(doc_id), doc_id, size]
    summed = running(aimed, kind, order, size, before, turn)
    asked = F.round("target").cast("long")
    whole, start = F.col("source_size"), F.col(named(before))

    def take(k: int) -> Column:
        begin = whole * k + start
        words = F.greatest(F.least(F.col(named(size)), asked - begin), F.lit(0))
        middle = F.try_divide(begin + words / F.lit(2.0), F.col("target"))
        places = [F.when(step == i, position(middle, s)) for i, s in enumerate(schedules)]
        return F.struct(
            F.lit(k + 1).alias("number"), words.cast("long").alias("words"), F.coalesce(*places).alias("position")
        )

    takes = F.filter(F.array(*[take(k) for k in range(times)]), lambda t: t["words"] > 0)
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda n, t: n + t["words"])
    return summed.withColumn("takes", takes).withColumn("taken", taken).drop(kind, before, turn)


def in_order(mixed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A row for each take of ``mix``, stored in the order of training: its number, words, position and at, the
    words of the mix before it. Documents that are not taken have one row, with no words, at the end."""
    rows = mixed.drop("number", "words", "position", "at")
    rows = rows.withColumn("take", F.explode_outer("takes")).drop("takes")
    all_, total = unused(rows.columns, "all_"), unused(rows.columns, "total_")
    rows = rows.select(
        *[named(c) for c in rows.columns if c != "take"],
        "take.number",
        F.coalesce("take.words", F.lit(0)).cast("long").alias("words"),
        "take.position",
        F.lit(0).cast("long").alias(all_),
    )
    order = [F.col("position").isNull(), "position", id_hash(doc_id), doc_id, "number"]
    return running(rows, all_, order, "words", "at", total).drop(all_, total)
