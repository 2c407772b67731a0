"""Periodic runs of words: maximal stretches that repeat a period, found with two suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word extends, at least
``least`` words and ``times`` periods long. Every run has a root that is the longest Lyndon word at its
place, in the order of words or in the reverse order, so there are at most two candidates a place:

1. Ukkonen's algorithm builds the suffix trees of the words and of their reversal.
2. A tour around a tree meets its leaves in the order of the suffixes. The least depth on the way between two
   neighbouring leaves is that of their lowest common ancestor; a table of minima over powers of two
   answers it for any two leaves in constant time. This is the longest common extension of two places:
   to the right in the one tree, to the left in the other.
3. The longest Lyndon word at a place ends before the next lesser suffix. Both orders of the words
   come from two tours of the same tree. The candidate's period is the length of that word.
4. All candidates are extended in both directions at once, in arrays; equal runs are taken once.

Most words are in no run. A run of L words has its first L - q words again as its last ones, and the two
overlap or touch, so each word of it is in a window of ``window_of()`` words that occurs twice in the document.
Trees are built for stretches of such words only: no run leaves them, as equal windows have equal hashes. Several stretches share a tree, parted by
numbers that occur once. Everything is a map over documents; nothing is shuffled. A tree takes
some 400 bytes a word, for the longest such stretch of one document at least.

Words are what stands between blanks and the control characters 9 to 13. Defined results: NULL, empty and
blank texts have no words, no runs and an empty collapsed text; every row is its own document, also if
ids repeat or are NULL; columns are kept unless a result has the same name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import map_batches, named, slices, small_batches, unused
from shoplake.llm.jaccard import FACTOR, mixed

LEAST, TIMES = 24, 3
#: Words of stretches that share a tree, about.
TREE_WORDS = 50_000

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_runs", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)


class SuffixTree:
    """Of a list of numbers whose last one occurs once. Node 0 is the root."""

    def __init__(self, line: list[int]) -> None:
        n, base = len(line), max(line) + 1
        start, end, link = [0], [0], [0]
        child: dict[int, int] = {}  # node * base + first number of the edge
        node = edge = length = open_ = 0
        for i, c in enumerate(line):
            fresh = 0  # the inner node that waits for its link
            open_ += 1
            while open_:
                if not length:
                    edge = i
                key = node * base + line[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    at, stop = start[below], end[below]
                    wide = (stop if stop <= i else i + 1) - at
                    if length >= wide:
                        node, edge, length = below, edge + wide, length - wide
                        continue
                    if line[at + length] == c:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    inner = len(start)
                    child[key] = inner
                    start += [at, i]
                    end += [at + length, n]
                    link += [0, 0]
                    child[inner * base + c] = inner + 1
                    start[below] = at + length
                    child[inner * base + line[at + length]] = below
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                open_ -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_ + 1
        self.n, self.nodes = n, len(start)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        self.ends = np.fromiter(child.values(), np.int64, len(child))
        self.parents, self.firsts = keys // base, keys % base
        self.wide = np.array(end, np.int64) - np.array(start, np.int64)
        self.leaf = np.array(end, np.int64) == n

    def children(self, order: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        """Children of all nodes in one list, last one first, and where those of each node begin and end.

        ``order``: the place of each number in the order of the tour.
        """
        by = np.lexsort((-order[self.firsts], self.parents))
        marks = np.searchsorted(self.parents[by], np.arange(self.nodes + 1))
        return self.ends[by].tolist(), marks[:-1].tolist(), marks[1:].tolist()

    def tour(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and before each one the depth of its common ancestor with the last."""
        kids, low, high = self.children(order)
        parent = np.zeros(self.nodes, np.int64)
        parent[self.ends] = self.parents
        above, wide, leaf = parent.tolist(), self.wide.tolist(), self.leaf.tolist()
        depth = [0] * self.nodes
        suffixes, shared = [], []
        n = least = self.n
        todo = kids[low[0] : high[0]]
        while todo:
            v = todo.pop()
            d = depth[above[v]]
            if d < least:
                least = d
            if leaf[v]:
                suffixes.append(n - d - wide[v])
                shared.append(least)
                least = n
            else:
                depth[v] = d + wide[v]
                todo += kids[low[v] : high[v]]
        self.depth, self.above = np.array(depth, np.int64), parent
        return np.array(suffixes, np.int64), np.array(shared, np.int64)

    def suffixes(self, order: np.ndarray) -> np.ndarray:
        """Suffixes in another order, after a tour."""
        kids, low, high = self.children(order)
        begin = (self.n - self.depth[self.above] - self.wide).tolist()
        leaf = self.leaf.tolist()
        found = []
        todo = kids[low[0] : high[0]]
        while todo:
            v = todo.pop()
            if leaf[v]:
                found.append(begin[v])
            else:
                todo += kids[low[v] : high[v]]
        return np.array(found, np.int64)


class Extensions:
    """How many numbers two places of a line have in common, from there on."""

    def __init__(self, suffixes: np.ndarray, shared: np.ndarray) -> None:
        self.rank = ranks(suffixes)
        levels = [shared.astype(np.int32)]
        while 2 << (len(levels) - 1) <= len(shared):
            last, half = levels[-1], 1 << (len(levels) - 1)
            level = last.copy()
            np.minimum(last[:-half], last[half:], out=level[:-half])
            levels.append(level)
        self.table = np.stack(levels)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places that differ."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp(high - low + 1)[1] - 1
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level) + 1]).astype(np.int64)


def ranks(suffixes: np.ndarray) -> np.ndarray:
    rank = np.empty(len(suffixes), np.int64)
    rank[suffixes] = np.arange(len(suffixes))
    return rank


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Of the longest Lyndon word at each place: it ends before the next lesser suffix."""
    r = [*rank.tolist(), -1]
    after = list(range(1, len(r) + 1))
    for i in range(len(r) - 2, -1, -1):
        j, mine = i + 1, r[i]
        while r[j] > mine:
            j = after[j]
        after[i] = j
    return np.array(after[:-1], np.int64) - np.arange(len(rank))


def runs_in(stretches: list[np.ndarray], least: int, times: int) -> np.ndarray:
    """(stretch, start, length, period) of all runs, in order. Words are numbers from 0."""
    seps = len(stretches) + 1
    parts: list[np.ndarray] = [np.zeros(1, np.int64)]
    for k, words in enumerate(stretches, 1):
        parts += [words.astype(np.int64) + seps, np.array([k], np.int64)]
    line = np.concatenate(parts)
    # numbers without gaps; those between stretches are least in both orders
    distinct, line = np.unique(line, return_inverse=True)
    up = np.arange(len(distinct))
    down = np.where(up < seps, up, len(distinct) - 1 + seps - up)
    n = len(line)
    tree = SuffixTree(line.tolist())
    right = Extensions(*tree.tour(up))
    lengths = [lyndon_lengths(right.rank), lyndon_lengths(ranks(tree.suffixes(down)))]
    del tree
    left = Extensions(*SuffixTree(line[::-1].tolist()).tour(up))
    place = np.tile(np.arange(n), 2)
    period = np.concatenate(lengths)
    there = (line[place] >= seps) & (place + period < n)
    place, period = place[there], period[there]
    same = line[place] == line[place + period]  # a run of two periods or more has such a root
    place, period = place[same], period[same]
    back = left(n - place, n - place - period)
    found = np.stack([place - back, back + period + right(place, place + period), period])
    found = found[:, (found[1] >= least) & (found[1] >= times * found[2])]
    found = np.unique(found[[0, 2, 1]], axis=1)[[0, 2, 1]]
    begins = np.cumsum([1, *[len(w) + 1 for w in stretches]])
    owner = np.searchsorted(begins, found[0], "right") - 1
    return np.stack([owner, found[0] - begins[owner], found[1], found[2]], axis=1)


def window_of(least: int, times: int) -> int:
    """Words that a run has again a period later; rounded down to a power of two."""
    return 1 << int(math.log2(least - least // times))


def repeated_stretches(codes: np.ndarray, owner: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """(start, end) of stretches of words that are in windows occurring twice in their document.

    ``codes``: words of several documents in a row; ``owner``: the document of each.
    """
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros((0, 2), np.int64)
    with np.errstate(over="ignore"):
        h, width = hashes[codes], 1
        while width < window:
            h = mixed(h[:-width] * FACTOR + h[width:])
            width *= 2
        h = mixed(h + owner[:n].astype(np.uint64) * FACTOR)
    inside = np.flatnonzero(owner[:n] == owner[window - 1 :])
    by = inside[np.argsort(h[inside], kind="stable")]
    equal = h[by[1:]] == h[by[:-1]]
    twice = np.union1d(by[1:][equal], by[:-1][equal])
    steps = np.zeros(len(codes) + 2, np.int64)  # one place before the first and one after the last
    steps[twice + 1] += 1
    steps[twice + window + 1] -= 1
    covered = np.cumsum(steps) > 0
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    cuts = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    cuts = cuts[covered[cuts] & covered[cuts + 1]]
    return np.sort(np.concatenate([edges, cuts, cuts])).reshape(-1, 2)


def runs_of(
    documents: list[list[bytes]], least: int = LEAST, times: int = TIMES, tree_words: int = TREE_WORDS
) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    places: dict[bytes, int] = {}
    codes = np.array([places.setdefault(w, len(places)) for d in documents for w in d], np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, places), np.uint64, len(places))
    sizes = np.array([len(d) for d in documents], np.int64)
    owner = np.repeat(np.arange(len(documents)), sizes)
    begins = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    spans = repeated_stretches(codes, owner, hashes, window_of(least, times))
    spans = spans[spans[:, 1] - spans[:, 0] >= least]
    k = 0
    while k < len(spans):
        first, held = k, 0
        while k < len(spans) and (k == first or held + spans[k, 1] - spans[k, 0] <= tree_words):
            held += spans[k, 1] - spans[k, 0]
            k += 1
        for s, start, length, period in runs_in([codes[a:b] for a, b in spans[first:k]], least, times).tolist():
            at = int(spans[first + s, 0])
            d = int(owner[at])
            found[d].append((at - int(begins[d]) + start, length, period))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The text without the words of a run after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words).decode()


def find_runs(
    docs: DataFrame,
    least: int = LEAST,
    times: int = TIMES,
    doc_id: str = "doc_id",
    text: str = "text",
    edit: Callable[[Any, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Adds n_words, n_runs, runs (by start, then period) and collapsed: the words, one blank between them, without
    those of a run after its first period.

    ``edit`` may change the words of a document, given its id, before runs are looked for.
    """
    if times < 2 or least < 4:
        raise ValueError("a run has two periods and four words at least")
    taken = {f.name for f in RESULTS}
    kept = [c for c in docs.columns if c.lower() not in taken]
    schema = T.StructType([*[docs.schema[c] for c in kept], *RESULTS.fields])
    arrow = to_arrow_schema(schema)
    words_from, id_from = unused(kept, "text_"), unused(kept, "id_")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, words_from):
            documents = [(t or "").encode().split() for t in part.column(words_from).to_pylist()]
            if edit is not None:
                ids = part.column(id_from).to_pylist()
                documents = [edit(i, d) for i, d in zip(ids, documents, strict=True)]
            found = runs_of(documents, least, times)
            told = [
                pa.array([len(d) for d in documents], pa.int64()),
                pa.array([len(r) for r in found], pa.int64()),
                pa.array(
                    [[dict(zip(RUN.names, r, strict=True)) for r in rs] for rs in found],
                    arrow.field("runs").type,
                ),
                pa.array([collapsed(d, r) for d, r in zip(documents, found, strict=True)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *told], schema=arrow)

    given = [F.col(named(c)) for c in kept]
    asked = small_batches(docs).select(
        *given, F.col(named(text)).alias(words_from), F.col(named(doc_id)).alias(id_from)
    )
    return map_batches(asked, run, schema)
