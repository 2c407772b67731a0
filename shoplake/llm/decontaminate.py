"""Benchmark decontamination with a generalised suffix automaton over the words of all test items.

Documents stream through the automaton word by word. Its state and the length matched so far
tell which windows of which items end at a word: a window is ``window`` consecutive words of an
item, or the whole of a shorter item. A run of words that all occur in the items is the
only place where a window can lie, so everything else is skipped with array operations.

The items are the small side: they are read in blocks of bounded size, an automaton is built for
each block and broadcast, and each block passes over the documents where they lie, without a
shuffle. Hot sources, copies and long documents only matter to the task that reads them. An item that is
longer than a block is cut into pieces that share ``window`` - 1 words, so that each window lies in one.

One block is a map of the documents. With more of them, documents are stored once with numbers; a pass then
reads their texts and writes only what it hit, and the hits of all passes are joined back at the end.

Defined results: NULL and empty texts have no words, so they are never hit; items without words
are ignored; items that share an id count as one item, and so do all items whose id is NULL
(their id is shown as the empty text); repeated documents each get their result; with no
items nothing is hit. Columns of the documents are kept unless a result has the same name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.config import scratch_dir
from shoplake.llm.common import (
    bins_for,
    cached,
    join_small,
    map_batches,
    named,
    slices,
    small_batches,
    stored,
    under_private_names,
    unused,
)

#: Text bytes of the items in one automaton: some 50 MB of it are broadcast.
BLOCK_BYTES = 4 * 1024 * 1024
#: An item is cut into pieces of about this share of a block.
PIECES_PER_BLOCK = 32

#: Lower-cases A-Z and blanks everything that is no word character; bytes beyond ASCII are.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """All substrings of all items, as states; which windows end in a state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = sorted({name for name, words in items if words})
        place = {name: i for i, name in enumerate(self.names)}
        coded = []
        for name, words in items:
            if words:
                codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append((place[name], codes))
                last = 0
                for c in codes:
                    last = self.extend(last, c)
        self.least = min((min(len(c), window) for _, c in coded), default=window)
        #: state -> items with a whole window that is a suffix of what the state stands for
        self.full: dict[int, set[int]] = {}
        #: state -> (words, item) of each shorter item that ends there
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, codes in coded:
            state, length = 0, 0
            for c in codes:
                state, length = self.step(state, length, c)
                if length >= window:
                    self.full.setdefault(self.suffix_state(state, window), set()).add(item)
            if len(codes) < window:
                self.short.setdefault(state, []).append((len(codes), item))

    def extend(self, last: int, c: int) -> int:
        """Add one word after ``last``; substrings that are there already are shared."""
        if c in self.next[last]:
            there = self.next[last][c]
            if self.length[there] == self.length[last] + 1:
                return there
            return self.split(last, c, there)
        new = self.state({}, self.length[last] + 1)
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            there = self.next[last][c]
            exact = self.length[there] == self.length[last] + 1
            self.link[new] = there if exact else self.split(last, c, there)
        return new

    def split(self, last: int, c: int, there: int) -> int:
        """A state for the shorter strings of ``there``, which have more places than the others."""
        copy = self.state(dict(self.next[there]), self.length[last] + 1)
        self.link[copy], self.link[there] = self.link[there], copy
        while last >= 0 and self.next[last].get(c) == there:
            self.next[last][c] = copy
            last = self.link[last]
        return copy

    def state(self, arcs: dict[int, int], length: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        """The longest suffix of (matched words + c) that occurs in an item."""
        while state and c not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if c in self.next[state]:
            return self.next[state][c], length + 1
        return 0, 0

    def suffix_state(self, state: int, length: int) -> int:
        """The state of the suffix with this many words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged (start, end) spans of words inside windows, and the items they are from."""
        codes = np.fromiter(
            map(self.vocabulary.get, words, [-1] * len(words)), np.int64, len(words)
        )
        known = np.flatnonzero(np.diff(np.concatenate([[0], codes >= 0, [0]]).astype(np.int8)))
        starts, ends = known[::2], known[1::2]
        long_enough = ends - starts >= self.least
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for a, b in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            state, length = 0, 0
            for i, c in enumerate(codes[a:b].tolist(), a):
                state, length = self.step(state, length, c)
                covered = 0
                if length >= self.window:
                    covered = self.window
                    items |= self.full[self.suffix_state(state, self.window)]
                if self.short:
                    at, most = state, length
                    while at > 0:
                        for n, item in self.short.get(at, ()):
                            if n <= most:
                                items.add(item)
                                covered = max(covered, n)
                        at = self.link[at]
                        most = self.length[at]
                if covered:
                    start = i + 1 - covered
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not spans or text is None:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join(kept) + text[at:]


SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
    ]
)


Found = tuple[int, list[tuple[int, int]], list[str]]


def cut_item(words: list[bytes], window: int, piece_bytes: int) -> Iterator[list[bytes]]:
    """Pieces of about this size, or of ``window`` words if these are longer, that have all windows of an item."""
    start = 0
    while words:
        end, held = start, 0
        while end < len(words) and (held < piece_bytes or end - start < window):
            held += len(words[end]) + 1
            end += 1
        yield words[start:end]
        if end == len(words):
            return
        start = end - window + 1


def item_pieces(items: DataFrame, item_id: str, text: str, window: int, piece_bytes: int) -> DataFrame:
    """(name, words) of all items with words, cut to pieces; equal ones are one row."""
    schema = T.StructType.fromDDL("name string, words string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "words"):
            names, pieces = [], []
            for name, t in zip(part.column("name").to_pylist(), part.column("words").to_pylist(), strict=True):
                for piece in cut_item(words_of(t), window, piece_bytes):
                    names.append(name)
                    pieces.append(b" ".join(piece).decode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(pieces, pa.string())], schema=arrow)

    told = small_batches(items).select(
        F.coalesce(F.col(named(item_id)).cast("string"), F.lit("")).alias("name"), F.col(named(text)).alias("words")
    )
    return told.mapInArrow(run, schema).distinct()


def item_blocks(
    items: DataFrame, item_id: str, text: str, window: int, block_bytes: int
) -> tuple[int, Iterator[list[tuple[str, list[bytes]]]]]:
    """How many blocks there are, and the items of each as words, about ``block_bytes`` of text."""
    piece_bytes = max(1, block_bytes // PIECES_PER_BLOCK)
    pieces = stored(item_pieces(items, item_id, text, window, piece_bytes), "items")
    size = pieces.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    n = bins_for(2 * size if size > block_bytes else size, block_bytes)

    def blocks() -> Iterator[list[tuple[str, list[bytes]]]]:
        for k in range(n):
            block = pieces.where(F.pmod(F.xxhash64("name", "words"), F.lit(n)) == k)
            rows = block.orderBy("name", "words").collect()
            yield [(r["name"], words_of(r["words"])) for r in rows]

    return n, blocks()


def match_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    clean: bool = False,
) -> DataFrame:
    """Adds n_words, n_hit, spans (word places, end exclusive) and item_ids (sorted) to documents.

    With ``clean`` the words of the spans, and what stands between them, are cut out of the text.
    """
    names = {f.name.lower() for f in RESULTS.fields}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    given = small_batches(docs).select(*[named(f.name) for f in kept])
    sc = docs.sparkSession.sparkContext
    n, blocks = item_blocks(items, item_id, item_text, window, block_bytes)
    if n == 1:
        found = finder(sc.broadcast(next(blocks)), window)

        def at_once(part: pa.RecordBatch, texts: list[str | None]) -> list[Found]:
            return [found(words_of(t)) for t in texts]

        return with_results(given, kept, text, at_once, clean)
    row = unused([*given.columns, *names], "row_")
    numbered = stored(given.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    hits = numbered_hits(numbered.select(F.col(row).alias("row"), F.col(named(text)).alias("text")), blocks, window)
    together = hits.groupBy(F.col("row").alias(row)).agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
    )
    joined = join_small(numbered, stored(together, "hits"), [row], "left").drop(row)

    def joined_hits(part: pa.RecordBatch, texts: list[str | None]) -> list[Found]:
        spans, ids = (part.column(c).to_pylist() for c in ("spans", "item_ids"))
        return [
            (len(words_of(t)), merge([(p["start"], p["end"]) for p in s or []]), sorted(i or []))
            for t, s, i in zip(texts, spans, ids, strict=True)
        ]

    return with_results(joined, kept, text, joined_hits, clean)


def finder(shared: Any, window: int) -> Callable[[list[bytes]], Found]:
    """A function that finds the windows of one broadcast block in the words of a text."""
    key = ("decontaminate", uuid.uuid4().hex)

    def run(words: list[bytes]) -> Found:
        automaton = cached(key, lambda: SuffixAutomaton(shared.value, window))
        spans, items = automaton.hits(words)
        return len(words), spans, sorted(automaton.names[k] for k in items)

    return run


def numbered_hits(
    texts: DataFrame, blocks: Iterable[list[tuple[str, list[bytes]]]], window: int
) -> DataFrame:
    """(row, spans, item_ids) of the texts that a block hits, written block by block."""
    spark = texts.sparkSession
    schema = T.StructType([T.StructField("row", T.LongType()), *RESULTS.fields[2:]])
    arrow = to_arrow_schema(schema)
    path = scratch_dir(spark, "block-hits")

    def matcher(found: Callable[[list[bytes]], Found]) -> Any:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                hit = []
                for row, t in zip(part.column("row").to_pylist(), part.column("text").to_pylist(), strict=True):
                    _, spans, ids = found(words_of(t))
                    if spans:
                        hit.append({"row": row, "spans": as_structs(spans), "item_ids": ids})
                yield pa.RecordBatch.from_pylist(hit, schema=arrow)

        return run

    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        texts.mapInArrow(matcher(finder(shared, window)), schema).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(schema).parquet(path)


def as_structs(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "end": b} for a, b in spans]


def with_results(
    rows: DataFrame,
    kept: list[T.StructField],
    text: str,
    find: Callable[[pa.RecordBatch, list[str | None]], list[Found]],
    clean: bool,
) -> DataFrame:
    """The kept columns of all rows with the results that ``find`` has for each."""
    schema = T.StructType(kept + RESULTS.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            texts = part.column(text).to_pylist()
            found = find(part, texts)
            columns = {f.name: part.column(f.name) for f in kept}
            if clean:
                texts = [cut(t, spans) for t, (_, spans, _) in zip(texts, found, strict=True)]
                columns[text] = pa.array(texts, arrow.field(text).type)
            told = {
                "n_words": [n for n, _, _ in found],
                "n_hit": [sum(b - a for a, b in spans) for _, spans, _ in found],
                "spans": [as_structs(spans) for _, spans, _ in found],
                "item_ids": [ids for _, _, ids in found],
            }
            for name, values in told.items():
                columns[name] = pa.array(values, arrow.field(name).type)
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in arrow], schema=arrow)

    return map_batches(rows, run, schema)


def judged(matched: DataFrame, coverage_percent: int = 5) -> DataFrame:
    """Adds n_items and contaminated: hit words are at least this share of all words."""
    return matched.withColumns(
        {
            "n_items": F.size("item_ids").cast("long"),
            "contaminated": (F.col("n_hit") > 0)
            & (100 * F.col("n_hit") >= coverage_percent * F.col("n_words")),
        }
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    coverage_percent: int = 5,
    text: str = "text",
    **names: Any,
) -> DataFrame:
    """Documents without those over the coverage limit; in the others, hit spans are cut out.

    A clean document stays as it is, byte for byte, and all given columns do, whatever their names are.
    """

    def judge(rows: DataFrame, content: str) -> DataFrame:
        matched = match_items(rows, items, window, content, clean=True, **names)
        return judged(matched, coverage_percent).where(~F.col("contaminated"))

    return under_private_names(docs, [text], judge)
