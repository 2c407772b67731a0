"""Multi-party chat formatting: one rendering of a dialogue for each of its participants.

Seen from one participant, its own turns are the assistant's and everyone else is a user with a
name; system turns stay system turns. The mask marks the text that the assistant is trained
on: the content of its turns and the mark that ends them.

A dialogue of any length is cut into parts of ``PART_TURNS`` turn numbers, and each part is
rendered by itself. Where turn numbers tie or are NULL, a part may have any number of rows: beyond
``PART_ROWS`` it is cut after each so many rows, which are numbered by ranges and running counts. So
no group grows without bound, and such a part gives several rows with its number. Offsets run
on over the parts of a dialogue: its parts, in the order of ``start``, are the whole rendering. Texts are
shuffled once, to their parts (those of cut parts some times more); who sees which part, and from which
offset on, is found from lengths. Only built-in functions are used.

Defined results: turns with the same number are ordered by speaker and text; repeated rows are
rendered once; a NULL turn number stands before all others; a NULL or empty speaker is called
``unknown`` and takes part like any other; NULL text is empty; rows with NULL conversation are one
conversation; a dialogue with only system turns has no participant and gives no rows; in
names every character but letters, digits, ``_`` and ``-`` becomes ``_``, and control marks inside
a text are broken up, so a text can't end its own turn. Other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoplake.llm.common import bins_for, join_small, stored

#: Turn numbers in one part, and most rows that are rendered together.
PART_TURNS, PART_ROWS = 256, 4096
#: Rows of large parts that are numbered together.
RANGE_ROWS = 16 * PART_ROWS
SYSTEM = "system"
UNKNOWN = "unknown"
START, END = "<|im_start|>", "<|im_end|>"

#: What names a range of turn numbers of a dialogue (as text, or that it has no id), and a part.
RANGE = ["c", "no_c", "p", "has_p"]
PART = [*RANGE, "cut"]
MASKS = "array<struct<start:bigint,end:bigint>>"


def safe_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1|>")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def header(speaker: Column, viewer: Column) -> Column:
    role = (
        F.when(speaker == SYSTEM, F.lit("system"))
        .when(speaker.eqNullSafe(viewer), F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), safe_name(speaker)))
    )
    return F.concat(F.lit(START), role, F.lit("\n"))


def rendered(turns: Column, viewer: Column, first: Column) -> Column:
    """Struct of the text and of the mask, with offsets from ``first`` on."""
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            header(t["speaker"], viewer).alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            (t["speaker"] == viewer).alias("own"),
        ),
    )
    nothing = F.struct(first.alias("at"), F.array().cast(MASKS).alias("masks"))

    def add(done: Column, p: Column) -> Column:
        begin = done["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        masks = F.when(p["own"], F.concat(done["masks"], span)).otherwise(done["masks"])
        return F.struct((end + 1).alias("at"), masks.alias("masks"))  # 1: the line end

    line = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    return F.struct(line.alias("text"), F.aggregate(pieces, nothing, add, lambda d: d["masks"]).alias("masks"))


def rotate(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    part_turns: int = PART_TURNS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """conv_id, participant, part, n_turns, start, text, masks: one row per part and participant.

    A part of more than ``part_rows`` different rows gives a row for each so many of them.

    ``start`` is the offset of the part in the participant's whole rendering, ``masks`` are
    (start, end) in the whole rendering, in characters.
    """
    name = F.when(F.coalesce(F.col(speaker), F.lit("")) == "", UNKNOWN).otherwise(F.col(speaker))
    part = F.floor(F.col(turn) / part_turns).cast("long")
    said = turns.select(
        F.coalesce(F.col(conv_id).cast("string"), F.lit("")).alias("c"),
        F.col(conv_id).isNull().alias("no_c"),
        F.coalesce(part, F.lit(0)).alias("p"),
        F.col(turn).isNotNull().alias("has_p"),
        F.struct(
            F.col(turn).cast("long").alias("turn"),
            name.alias("speaker"),
            safe_text(F.col(text)).alias("text"),
        ).alias("t"),
    )
    own = stored(lengths(said, RANGE), "own")
    large = own.groupBy(*RANGE).agg(F.sum("n").alias("rows")).where(F.col("rows") > part_rows)
    large = stored(large, "large")
    rows = large.agg(F.sum("rows")).first()[0]
    whole = F.lit(0).cast("long").alias("cut")
    if rows:
        names = large.select(*RANGE)
        cut = stored(cut_rows(join_small(said, names, RANGE, "left_semi"), part_rows, rows), "cut")
        said = join_small(said, names, RANGE, "left_anti").select(*RANGE, whole, "t").unionByName(cut)
        own = join_small(own, names, RANGE, "left_anti").select("*", whole).unionByName(lengths(cut, PART))
        own = stored(own, "own-cut")
    else:
        said, own = said.select(*RANGE, whole, "t"), own.select("*", whole)
    parts = said.groupBy(*PART).agg(F.sort_array(F.collect_set("t")).alias("turns"))
    seen = stored(views(own), "views")
    made = parts.join(seen, PART).select(
        F.when(~F.col("no_c"), F.col("c").cast(turns.schema[conv_id].dataType)).alias("conv_id"),
        "participant",
        F.when(F.col("has_p"), F.col("p")).alias("part"),
        F.size("turns").cast("long").alias("n_turns"),
        "start",
        rendered(F.col("turns"), F.col("participant"), F.col("start")).alias("made"),
    )
    return made.select("conv_id", "participant", "part", "n_turns", "start", "made.text", "made.masks")


def cut_rows(said: DataFrame, part_rows: int, rows: int) -> DataFrame:
    """The different rows of large ranges of turn numbers, in parts of ``part_rows`` rows in order."""
    order = [*RANGE, "t"]
    ranged = said.distinct().repartitionByRange(bins_for(rows, RANGE_ROWS), *order).sortWithinPartitions(*order)
    # the partition above, the place in it below
    placed = stored(ranged.withColumn("id", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("at", F.shiftright("id", 33))
    counts = placed.groupBy(*RANGE, "at").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = W.partitionBy(*RANGE).orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    offsets = stored(counts.select(*RANGE, "at", offset.alias("offset")), "offsets")
    numbered = join_small(placed, offsets, [*RANGE, "at"], "inner")
    cut = F.floor((F.col("id") + F.col("offset")) / part_rows).cast("long")
    return numbered.select(*RANGE, cut.alias("cut"), "t")


def lengths(said: DataFrame, part: list[str]) -> DataFrame:
    """How many different rows, and of which length, each speaker has in each part."""
    t = F.col("t")
    each = said.select(
        *part,
        t["speaker"].alias("speaker"),
        t["turn"].alias("turn"),
        F.xxhash64(t["text"]).alias("text_hash"),
        F.length(t["text"]).cast("long").alias("size"),
    ).distinct()
    return each.groupBy(*part, "speaker").agg(F.count("*").alias("n"), F.sum("size").alias("size"))


def views(own: DataFrame) -> DataFrame:
    """Each part with each participant of its dialogue, and where it starts in that rendering.

    Needs lengths only, so no text is shuffled for it: seen from a participant, its own turns
    differ from what others see in their header alone.
    """
    as_user = F.length(header(F.col("speaker"), F.lit(None)))
    per_turn = as_user + len(END) + 1
    whole = own.groupBy(*PART).agg(F.sum(F.col("size") + F.col("n") * per_turn).alias("size"))
    people = own.where(F.col("speaker") != SYSTEM).select("c", "no_c", "speaker").distinct()
    seen = whole.join(people, ["c", "no_c"]).join(own.select(*PART, "speaker", "n"), [*PART, "speaker"], "left")
    saved = as_user - F.length(header(F.col("speaker"), F.col("speaker")))
    size = F.col("size") - F.coalesce("n", F.lit(0)) * saved
    before = W.partitionBy("c", "no_c", "speaker").orderBy("has_p", "p", "cut").rowsBetween(W.unboundedPreceding, -1)
    return seen.select(
        *PART,
        F.col("speaker").alias("participant"),
        F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long").alias("start"),
    )
