"""Collocations: frequent phrases of two to four words whose parts are rarely seen without each other.

Counts are kept in weighted acyclic automata: an arc has a word, and as its weight the count of the
phrase that ends with it.

1. A map turns documents into shards of some two million words: the words and their counts, and the texts as
   places in that list, with 0 between pieces. Word counts are added up per language, and the words that
   occur ``least`` times get numbers. A phrase is only as frequent as its words, so all others part pieces.
2. Shards learn the counts of their pairs of words in all shards (``totals``). No longer phrase is more frequent than
   one of its pairs, so rare pairs end phrases too. Each shard sorts the phrases that are left, first by
   first word, and counts them layer by layer: the sorted phrases of n words are states that the next word extends.
3. Sorted phrases move by prefix range (``ranges_of``). There the transducers of all shards are built from
   them, united and their weights added; arcs of phrases that are too rare go, and states with equal futures
   become one (``CountTransducer``). With very many shards this takes several rounds: groups of shards and coarse
   ranges first, so that each shard or group sends at most ``FAN`` rows a round.
4. A candidate asks for the counts of its parts. The distinct parts go to their ranges, where an acceptor
   of them is composed with the transducer. A part is as frequent as the whole, so it is always there.
5. Scores, containing phrases and the best of each language are joins and sums.

The prefix of a phrase that decides on its range is the shortest of at least two words that has a word seen at most
``HOT`` times, else the whole phrase. So no range is large because of a frequent prefix, as
such a prefix is seen ``HOT`` times at most. The lowest bit of a word's number tells whether it is hot.

Defined results: text is lower-cased in A-Z, pieces end at ``.,;:!?`` and the control characters 10 to 13, words are
parted by blanks and tabs. NULL and empty texts have no words; a NULL language is ``und`` (as a language
of that name); repeated rows count each time; ids are not used, nor are other columns. Prefix ranges and equal
futures are told by 64-bit hashes, words and phrases by themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import bins_for, is_small, join_small, named, running, slices, small_batches, stored
from shoplake.llm.jaccard import FACTOR, mixed
from shoplake.llm.totals import joined, pack, pack_sorted, totals, unpack

LONGEST = 4
LEAST, TOP = 30, 2000
#: A phrase is left out if one that contains it is seen at least as often as this many in a hundred.
COVER = 80
SHARD_WORDS = 1_000_000
#: Words of text whose phrases share a range, about; words seen more often are hot.
RANGE_WORDS = HOT = 1_000_000
#: Most ranges that a shard is cut into at a time, and most shards that are united at a time.
FAN = 256

# Lower case for A-Z, a blank for a tab, a line break for all that ends a piece.
TABLE = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
BREAK, NOTHING = 0, 1


class Shard:
    """Collects the texts of one shard."""

    def __init__(self) -> None:
        self.places: dict[str, dict[bytes, int]] = {}
        self.size = 2
        self.codes: list[np.ndarray] = []
        self.held = 0

    def add(self, lang: str, text: str) -> None:
        words = text.encode().translate(TABLE).replace(b"\n", b" \n ").split(b" ")
        places = self.places.setdefault(lang, {b"\n": BREAK, b"": NOTHING})
        size = self.size - len(places)
        codes = [places.setdefault(w, size + len(places)) for w in words]
        self.size = size + len(places)
        line = np.array([*codes, BREAK], np.uint32)
        self.codes.append(line[line != NOTHING])
        self.held += len(self.codes[-1])

    def rows(self, name: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The shard, then its words."""
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes, minlength=self.size)
        yield pa.RecordBatch.from_pylist([{"shard": name, "codes": pack(codes)}], schema)
        for lang, places in self.places.items():
            words = [(w, c) for w, c in places.items() if c > NOTHING]
            for s in range(0, len(words), 20_000):
                part = words[s : s + 20_000]
                code = np.array([c for _, c in part], np.int64)
                columns = {
                    "shard": pa.array(np.full(len(part), name, np.int64)),
                    "codes": pa.nulls(len(part), pa.binary()),
                    "lang": pa.array([lang] * len(part)),
                    "word": pa.array([w for w, _ in part], pa.binary()).cast(pa.string()),
                    "code": pa.array(code.astype(np.int32)),
                    "n": pa.array(counts[code].astype(np.int64)),
                }
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


SHARD = T.StructType(
    [
        *[T.StructField(n, t) for n, t in (("shard", T.LongType()), ("codes", T.BinaryType()))],
        *[T.StructField(n, T.StringType()) for n in ("lang", "word")],
        *[T.StructField(n, t) for n, t in (("code", T.IntegerType()), ("n", T.LongType()))],
    ]
)


def shards(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """A row for each shard, with codes, and one for each of its words."""
    arrow = to_arrow_schema(SHARD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        done = (task.partitionId() if task else 0) << 32
        shard = Shard()
        for part in slices(batches, "text"):
            for kind, content in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                shard.add(kind, content)
            if shard.held >= SHARD_WORDS:
                yield from shard.rows(done, arrow)
                shard, done = Shard(), done + 1
        if shard.codes:
            yield from shard.rows(done, arrow)

    given = small_batches(docs).select(
        F.coalesce(F.col(named(lang)).cast("string"), F.lit("und")).alias("lang"), F.col(named(text)).alias("text")
    )
    return given.where(F.col("text").isNotNull()).mapInArrow(run, SHARD)


def lexicon(rows: DataFrame, least: int) -> DataFrame:
    """(lang, word, n, id) of the words seen often enough, stored."""
    words = rows.where(F.col("word").isNotNull()).groupBy("lang", "word").agg(F.sum("n").cast("long").alias("n"))
    found = words.where(F.col("n") >= least)
    found = found.withColumns({"all": F.lit(0).cast("long"), "one": F.lit(1).cast("long")})
    numbered = running(found, "all", ["lang", "word"], "one", "place", "kinds")
    hot = (F.col("n") > HOT).cast("long")
    # from 1 on, as 0 stands between pieces
    return stored(numbered.select("lang", "word", "n", ((F.col("place") + 1) * 2 + hot).alias("id")), "lexicon")


def keyed(states: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (states.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64)


def followed(line: np.ndarray) -> np.ndarray:
    """Places that begin a pair: no phrase goes over a 0."""
    return np.flatnonzero((line[:-1] != 0) & (line[1:] != 0))


def pairs_of(line: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, in the order of keys that are spread evenly; their counts; and which each place begins.

    The keys are the numbers of both words with their bits mixed, so different pairs have different keys.
    """
    starts = followed(line)
    distinct, place, counts = np.unique(
        keyed(line[starts], line[starts + 1]), return_inverse=True, return_counts=True
    )
    first, second = (distinct >> np.uint64(32)).astype(np.int64), (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64)
    with np.errstate(over="ignore"):
        keys = mixed(keyed(ids[first], ids[second]))
    order = np.argsort(keys)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return keys[order], counts[order], rank[place]


def sorted_phrases(line: np.ndarray, often: np.ndarray) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """For 2, 3 and 4 words: the distinct phrases in order, a column for each word, and their counts.

    ``line``: places of words; ``often``: for each place of the line, whether it begins a pair that may be in a phrase.
    """
    out = []
    starts = np.flatnonzero(often)
    states, columns = line[starts], [np.arange(int(line.max(initial=0)) + 1)]
    often = np.append(often, np.zeros(LONGEST, bool))
    for k in range(1, LONGEST):
        more = often[starts + k - 1]
        starts, states = starts[more], states[more]
        keys, states, counts = np.unique(
            keyed(states, line[starts + k]), return_inverse=True, return_counts=True
        )
        before = (keys >> np.uint64(32)).astype(np.int64)
        columns = [c[before] for c in columns] + [(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        out.append((columns, counts))
    return out


def ranges_of(words: list[np.ndarray], ranges: int) -> np.ndarray:
    """The prefix range of each phrase; ``words`` has a column for each word."""
    with np.errstate(over="ignore"):
        h = mixed(words[0].astype(np.uint64) * FACTOR + words[1].astype(np.uint64))
        hot = (words[0] & words[1] & 1).astype(bool)
        for w in words[2:]:
            h = np.where(hot, mixed(h * FACTOR + w.astype(np.uint64)), h)
            hot &= (w & 1).astype(bool)
    return (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def pieces(phrases: list[tuple[list[np.ndarray], np.ndarray]], ranges: int) -> dict[int, list[bytes]]:
    """Sorted phrases of each range: for each length its columns and counts, packed."""
    cut = []
    for words, counts in phrases:
        at = ranges_of(words, ranges)
        order = np.argsort(at, kind="stable")
        marks = np.searchsorted(at[order], np.arange(ranges + 1)).tolist()
        cut.append(([w[order].astype(np.uint32) for w in words] + [counts[order].astype(np.uint64)], marks))
    out = {}
    for r in range(ranges):
        if any(marks[r] < marks[r + 1] for _, marks in cut):
            out[r] = [pack(c[marks[r] : marks[r + 1]]) for columns, marks in cut for c in columns]
    return out


def opened(data: list[bytes]) -> list[list[np.ndarray]]:
    """For 2, 3 and 4 words: columns and counts."""
    out, at = [], 0
    for k in range(2, LONGEST + 1):
        out.append([unpack(d, "u4") for d in data[at : at + k]] + [unpack(data[at + k], "u8")])
        at += k + 1
    return out


class CountTransducer:
    """Layers of arcs; those of a layer are sorted by (state before, word).

    ``arcs``: state before and word in one number; ``weights``: the count of the phrase that ends with
    the arc, or 0; ``after``: the state that it leads to.
    """

    def __init__(self, arcs: list[np.ndarray], weights: list[np.ndarray], after: list[np.ndarray]) -> None:
        self.arcs, self.weights, self.after = arcs, weights, after

    @classmethod
    def union(cls, shards: list[list[list[np.ndarray]]]) -> CountTransducer:
        """Of the sorted phrases of several shards, with their counts added up."""
        lengths = range(len(shards[0]))
        phrases = [[np.concatenate([s[k][c] for s in shards]) for c in range(k + 3)] for k in lengths]
        states = [np.zeros(len(p[0]), np.int64) for p in phrases]  # where each phrase has got to
        arcs, weights, after = [], [], []
        for depth in range(LONGEST):
            longer = [k for k in lengths if k + 2 > depth]
            keys = np.concatenate([keyed(states[k], phrases[k][depth]) for k in longer])
            found, place = np.unique(keys, return_inverse=True)
            total = np.zeros(len(found), np.uint64)
            start = 0
            for k in longer:
                states[k] = place[start : start + len(states[k])]
                start += len(states[k])
                if k + 1 == depth:
                    np.add.at(total, states[k], phrases[k][-1])
            arcs.append(found)
            weights.append(total)
            after.append(np.arange(len(found)))
        return cls(arcs, weights, after)

    def phrases(self) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """For 2, 3 and 4 words: columns and counts of all phrases, sorted. For automata that are still trees."""
        out: list[tuple[list[np.ndarray], np.ndarray]] = []
        columns: list[np.ndarray] = []
        for depth, arcs in enumerate(self.arcs):
            before = (arcs >> np.uint64(32)).astype(np.int64)
            columns = [c[before] for c in columns] + [(arcs & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            if depth:
                ends = self.weights[depth] > 0
                out.append(([c[ends] for c in columns], self.weights[depth][ends]))
        return out

    def pruned(self, least: int) -> CountTransducer:
        """Without rarer phrases, as a tree."""
        arcs, weights = list(self.arcs), [np.where(w >= least, w, 0) for w in self.weights]
        wanted = np.zeros(0, np.int64)  # states that have arcs
        for depth in reversed(range(LONGEST)):
            kept = weights[depth] > 0
            kept[wanted] = True
            number = np.cumsum(kept) - 1
            if depth + 1 < LONGEST:
                below = arcs[depth + 1]
                arcs[depth + 1] = keyed(number[(below >> np.uint64(32)).astype(np.int64)], below & np.uint64(0xFFFFFFFF))
            arcs[depth], weights[depth] = arcs[depth][kept], weights[depth][kept]
            wanted = np.unique(arcs[depth] >> np.uint64(32)).astype(np.int64) if depth else wanted
        return CountTransducer(arcs, weights, [np.arange(len(a)) for a in arcs])

    def minimal(self) -> CountTransducer:
        """States with equal futures become one, from the last layer on."""
        arcs, weights, after = list(self.arcs), list(self.weights), list(self.after)
        after[-1] = np.zeros(len(arcs[-1]), np.int64)
        for depth in reversed(range(1, LONGEST)):
            states = len(arcs[depth - 1])
            source = (arcs[depth] >> np.uint64(32)).astype(np.int64)
            with np.errstate(over="ignore"):
                one = mixed((arcs[depth] & np.uint64(0xFFFFFFFF)) * FACTOR + weights[depth].astype(np.uint64))
                one = mixed(one * FACTOR + after[depth].astype(np.uint64))
                future = np.zeros(states, np.uint64)
                np.add.at(future, source, one)
            _, first, kind = np.unique(future, return_index=True, return_inverse=True)
            after[depth - 1] = kind
            kept = np.isin(source, first)
            moved = keyed(kind[source[kept]], arcs[depth][kept] & np.uint64(0xFFFFFFFF))
            order = np.argsort(moved)
            arcs[depth], weights[depth], after[depth] = (
                moved[order], weights[depth][kept][order], after[depth][kept][order],
            )
        return CountTransducer(arcs, weights, after)

    def compose(self, asked: list[np.ndarray]) -> np.ndarray:
        """Weights of phrases of one length, 0 for those that are not there: both automata are walked together."""
        states = np.zeros(len(asked[0]), np.int64)
        there = np.ones(len(asked[0]), bool)
        weights = np.zeros(len(asked[0]), np.uint64)
        for depth, words in enumerate(asked):
            keys = keyed(states, words)
            at = np.searchsorted(self.arcs[depth], keys)
            at = np.minimum(at, max(len(self.arcs[depth]) - 1, 0))
            there &= self.arcs[depth][at] == keys if len(self.arcs[depth]) else False
            if not len(self.arcs[depth]):
                break
            states, weights = self.after[depth][at], self.weights[depth][at]
        return np.where(there, weights, 0)

    def packed(self) -> list[bytes]:
        columns = zip(self.arcs, self.weights, self.after, strict=True)
        return [pack(x.astype(np.uint64)) for layer in columns for x in layer]

    @classmethod
    def unpacked(cls, data: list[bytes]) -> CountTransducer:
        layers = [unpack(d, "u8") for d in data]
        return cls(layers[::3], layers[1::3], [x.astype(np.int64) for x in layers[2::3]])


PIECE = "batch long, range long, data array<binary>"
MERGED = "range long, data array<binary>, phrase array<long>, a long"


LINE = "shard long, sender string, line binary, ids binary, keys binary, counts binary"


def lines(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Every shard's text in its frequent words only, with 0 for others, and its pairs."""

    def run(key: tuple[int], shard: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        codes = unpack(shard["codes"].iloc[0], "u4")
        order = np.argsort(told["id"].to_numpy())
        ids = np.append(0, told["id"].to_numpy(np.int64)[order])
        place = np.zeros(int(codes.max()) + 1, np.uint32)
        place[told["code"].to_numpy(np.int64)[order]] = np.arange(1, len(ids))
        line = place[codes]
        keys, counts, _ = pairs_of(line, ids)
        columns = [pack(line), pack(ids), pack_sorted(keys), pack(counts.astype(np.uint64))]
        return pd.DataFrame([(key[0], str(key[0]), *columns)], columns=["shard", "sender", "line", "ids", "keys", "counts"])

    texts = rows.where(F.col("codes").isNotNull()).select("shard", "codes")
    return texts.groupBy("shard").cogroup(words.groupBy("owner")).applyInPandas(run, LINE)


def sent(lines_: DataFrame, answers: DataFrame, least: int, batches: int, ranges: int) -> DataFrame:
    """The sorted phrases of every shard whose pairs are all frequent, by range."""

    def run(key: tuple[str], shard: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        line, ids = unpack(shard["line"].iloc[0], "u4"), unpack(shard["ids"].iloc[0], "i8")
        often = np.zeros(len(line), bool)
        often[followed(line)] = (joined(told) >= least)[pairs_of(line, ids)[2]]
        phrases = [([ids[w] for w in ws], n) for ws, n in sorted_phrases(line, often)]
        batch = int(mixed(np.array([int(key[0])], np.uint64))[0] % np.uint64(batches))
        found = [(batch, r, d) for r, d in pieces(phrases, ranges).items()]
        return pd.DataFrame(found, columns=["batch", "range", "data"])

    given = answers.select(F.col("sender").alias("to"), "range", "totals")
    return lines_.select("sender", "line", "ids").groupBy("sender").cogroup(given.groupBy("to")).applyInPandas(run, PIECE)


def united(sent_: DataFrame, ranges: int) -> DataFrame:
    """One round: groups of shards become one, which is cut into finer ranges."""

    def run(key: tuple[int, int], frame: pd.DataFrame) -> pd.DataFrame:
        whole = CountTransducer.union([opened(d) for d in frame["data"]])
        found = [(key[0] // FAN, r, d) for r, d in pieces(whole.phrases(), ranges).items()]
        return pd.DataFrame(found, columns=["batch", "range", "data"])

    return sent_.groupBy("batch", "range").applyInPandas(run, PIECE)


def merged(sent_: DataFrame, least: int) -> DataFrame:
    """The last round: a row with the minimal automaton of each range, and one for each frequent phrase."""

    def run(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        whole = CountTransducer.union([opened(d) for d in frame["data"]]).pruned(least)
        found: list[tuple[object, ...]] = [(key[0], whole.minimal().packed(), None, None)]
        for words, counts in whole.phrases():
            table = np.stack(words, axis=1)
            found += [(key[0], None, p, int(n)) for p, n in zip(table, counts, strict=True)]
        return pd.DataFrame(found, columns=["range", "data", "phrase", "a"])

    return sent_.groupBy("range").applyInPandas(run, MERGED)


def part_counts(asked: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """(phrase, f) of the distinct phrases asked for."""

    def place(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = np.zeros(len(frame), np.int64)
            sizes = frame["phrase"].map(len).to_numpy()
            for size in range(2, LONGEST):
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    words = np.stack(frame["phrase"].to_numpy()[rows])
                    at[rows] = ranges_of([words[:, c] for c in range(size)], ranges)
            yield frame.assign(range=at)

    def run(asks: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        f = np.zeros(len(asks), np.int64)
        if len(told) and len(asks):
            automaton = CountTransducer.unpacked(list(told["data"].iloc[0]))
            sizes = asks["phrase"].map(len).to_numpy()
            for size in range(2, LONGEST):
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    words = np.stack(asks["phrase"].to_numpy()[rows])
                    f[rows] = automaton.compose([words[:, c] for c in range(size)])
        return pd.DataFrame({"phrase": asks["phrase"], "f": f})

    placed = asked.mapInPandas(place, "phrase array<long>, range long")
    automata = automata.select(F.col("range").alias("of_range"), "data")
    both = placed.groupBy("range").cogroup(automata.groupBy("of_range"))
    return both.applyInPandas(run, "phrase array<long>, f long")


def exact(column: str) -> Column:
    return F.col(column).cast("decimal(28,0)")


def scored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds l, r and score of the weakest cut."""
    size = F.size("phrase")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns(
        {"first": F.slice("phrase", F.lit(1), F.col("k")), "rest": F.slice("phrase", F.col("k") + 1, size - F.col("k"))}
    )
    told = cuts.join(counts.select(F.col("phrase").alias("first"), F.col("f").alias("l")), "first")
    told = told.join(counts.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr("cast(a as decimal(28,0)) * 2000000 div (cast(l as decimal(28,0)) + r)")
    told = told.withColumn("cut", F.struct(score.cast("long").alias("score"), "k", "l", "r"))
    return told.groupBy("phrase", "a").agg(F.min("cut").alias("cut")).select("phrase", "a", "cut.l", "cut.r", "cut.score")


def uncovered(found: DataFrame, cover: int) -> DataFrame:
    """Without phrases that a longer one contains nearly always."""
    longer = found.where(F.size("phrase") > 2).withColumn("n", F.explode(F.sequence(F.lit(2), F.size("phrase") - 1)))
    longer = longer.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("phrase") - F.col("n") + 1)))
    most = longer.groupBy(F.slice("phrase", F.col("i"), F.col("n")).alias("phrase")).agg(F.max("a").alias("most"))
    told = found.join(most, "phrase", "left")
    return told.where(F.col("most").isNull() | (exact("most") * 100 < exact("a") * cover)).drop("most")


def spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds lang and the phrase as text, in place of the numbers."""
    small = is_small(words)
    for k in range(LONGEST):
        mine = words.select(*[F.col(c).alias(f"{c}{k}") for c in ("id", "word", "lang")])
        found = found.withColumn(f"id{k}", F.try_element_at("phrase", F.lit(k + 1)))
        found = found.join(F.broadcast(mine) if small else mine, f"id{k}", "left")
    text = F.concat_ws(" ", *[f"word{k}" for k in range(LONGEST)])
    return found.withColumns({"lang": F.col("lang0"), "phrase": text}).select("lang", "phrase", "a", "l", "r", "score")


def collocations(
    docs: DataFrame, least: int = LEAST, cover: int = COVER, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """lang, phrase, a (its count), l and r (those of the parts of its weakest cut), n (words of the language) and score,
    2,000,000 a / (l + r) rounded down, of every phrase seen ``least`` times that no longer one covers."""
    rows = stored(shards(docs, text, lang), "shards")
    words = lexicon(rows, least)
    counted = rows.where(F.col("word").isNotNull())
    sizes = stored(counted.groupBy("lang").agg(F.sum("n").cast("long").alias("n")), "sizes")
    tokens = sizes.agg(F.sum("n")).first()[0] or 0
    n_shards = rows.where(F.col("codes").isNotNull()).count()
    known = join_small(counted.select("shard", "code", "lang", "word"), words, ["lang", "word"], "inner")
    texts = stored(lines(rows, known.select(F.col("shard").alias("owner"), "code", "id")), "lines")
    pairs = totals(texts, n_shards, tokens, "pairs")
    ranges, batches = bins_for(tokens, RANGE_WORDS), bins_for(n_shards, FAN)
    now = sent(texts, pairs, least, batches, min(FAN, ranges))
    cut = FAN
    while batches > 1:
        cut *= FAN
        now = united(stored(now, "united"), min(cut, ranges))
        batches = bins_for(batches, FAN)
    ranges = min(cut, ranges)
    told = stored(merged(now, least), "merged")
    found = told.where(F.col("phrase").isNotNull()).select("phrase", "a")
    both = "array(slice(phrase, 1, n), slice(phrase, size(phrase) - n + 1, n))"
    ends = F.expr(f"flatten(transform(sequence(2, size(phrase) - 1), n -> {both}))")
    parts = found.where(F.size("phrase") > 2).select(F.explode(ends).alias("phrase"))
    counts = part_counts(parts.distinct(), told.where(F.col("data").isNotNull()).select("range", "data"), ranges)
    counts = stored(counts.unionByName(words.select(F.array("id").alias("phrase"), F.col("n").alias("f"))), "parts")
    best = spelled(scored(uncovered(found, cover), counts), words)
    return join_small(best, sizes, ["lang"], "inner")


def best_of_each(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language, with their rank, by score, count and phrase.

    The best of each hash part of a language are taken first, so no language is sorted in one task.
    """
    found = stored(found, "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = max(1, round((found.count() / max(1, top)) ** 0.5))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = found.withColumn("part", part)
    some = some.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
    some = some.where(F.col("rank") <= top).drop("rank", "part")
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
