"""Language-model scores from a weighted backoff automaton, learned and applied as sums and joins.

The model has a root with add-one counts of words, a state for every training word, however rare, and a state for every
pair of words that training has twice or more. A one-word state has an arc for each word that followed it, with the
discounted relative frequency; its failure arc leads to the root and has what the arcs leave over. A two-word state
has arcs for the words that followed the pair; its failure arc leads to the state of its last word, and weighs as much as
``PRIOR`` occurrences. A text is read once from left to right, and carries the longest history that is a state: what its
arc gives (if any) and the failure arc times the next shorter history are added. Since the state after a word
depends on the last two words only, all words of many texts step at once in arrays. Probabilities of all words
after any state add up to one, with one share kept for unknown words.

The counts belong to all training documents and grow with them, so no task ever holds the model:

1. Documents are coded in blocks of some million words where they lie: the sorted 64-bit hashes of the
   block's words, and the texts as places in that list.
2. Blocks ask for the totals of their words and of their pairs (``totals``: each block sends a bounded number of
   rows, so the requests grow with the blocks).
3. With the totals of its pairs, each block asks for the words that follow its two-word states, and counts the distinct
   followers of its words, over the pairs that it owns: these counts are added up in the same exchange.
4. Each block meets its answers and scores its texts.

Words are compared by 64-bit hashes; longer n-grams by as many bits as make it unlikely, one in 16 million, that an n-gram
shares them with any other (``bits_for``).

Defined results: NULL and empty texts consist of the end token alone; a document with a NULL id counts
as the empty id; repeated rows count and are scored each time; without training documents
every word is unknown (N = V = 0) and the scores are 0. Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import slices, small_batches, stored
from shoplake.llm.jaccard import FACTOR, mixed
from shoplake.llm.totals import joined, owned, pack, pack_sorted, totals, unpack, unpack_sorted

#: Taken from the count of each follower of a word, for the failure arc.
DISCOUNT = 0.75
#: A pair is a state if it is seen so often; the followers of others are all but certain to be unseen.
LEAST_PAIR = 2
#: Occurrences that the failure arc of a two-word state weighs as much as.
PRIOR = 8
BLOCK_WORDS = 1_000_000
#: Bits of a hash beyond those that number all n-grams.
SPARE_BITS = 24

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: No word has white space in it, so this is no word.
END = b"\n"


class Coder:
    """Collects the documents of one block."""

    def __init__(self) -> None:
        self.places: dict[bytes, int] = {END: 0}
        self.ids: list[Any] = []
        self.train: list[bool] = []
        self.lengths: list[int] = []
        self.codes: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: Any, train: bool, text: str | None) -> None:
        words = (text or "").encode().translate(LOWER).split()
        words.append(END)
        places = self.places
        self.codes.append(np.array([places.setdefault(w, len(places)) for w in words], np.uint32))
        self.ids.append(doc_id)
        self.train.append(bool(train))
        self.lengths.append(len(words))
        self.held += len(words)

    def block(self, name: str) -> dict[str, Any]:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.places), np.uint64, len(self.places))
        words, rank = np.unique(hashes, return_inverse=True)
        codes = rank.astype(np.uint32)[np.concatenate(self.codes)]
        train = np.repeat(np.array(self.train, bool), self.lengths)
        counts = np.bincount(codes[train], minlength=len(words)).astype(np.uint32)
        return {
            "block": name,
            "ids": self.ids,
            "train": np.array(self.train, np.uint8).tobytes(),
            "lengths": np.array(self.lengths, np.uint32).tobytes(),
            "codes": pack(codes),
            "words": pack_sorted(words),
            "counts": pack(counts.astype(np.uint64)),
            "n_tokens": len(codes),
            "train_tokens": int(train.sum()),
        }


def coded_blocks(docs: DataFrame, doc_id: str, text: str, train: Column) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("ids", T.ArrayType(docs.schema[doc_id].dataType)),
            *[T.StructField(c, T.BinaryType()) for c in ("train", "lengths", "codes", "words", "counts")],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        prefix = f"{task.partitionId()}-{task.taskAttemptId()}" if task else "0"
        coder, done = Coder(), 0
        for part in slices(batches, "text"):
            rows = zip(*(part.column(c).to_pylist() for c in ("id", "train", "text")), strict=True)
            for row in rows:
                coder.add(*row)
                if coder.held >= BLOCK_WORDS:
                    yield pa.RecordBatch.from_pylist([coder.block(f"{prefix}-{done}")], arrow)
                    coder, done = Coder(), done + 1
        if coder.ids:
            yield pa.RecordBatch.from_pylist([coder.block(f"{prefix}-{done}")], arrow)

    rows = small_batches(docs).select(
        F.col(doc_id).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, schema)


FOLLOWERS = np.uint64(0xD6E8FEB86659FD93)


def bits_for(n: int) -> int:
    return min(64, max(1, n).bit_length() + SPARE_BITS)


class Block:
    """The texts of a block, with their pairs of words."""

    def __init__(self, row: dict[str, Any], bits: int) -> None:
        self.codes = unpack(row["codes"], "u4").astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.train = np.frombuffer(row["train"], np.uint8).astype(bool)
        self.words = unpack_sorted(row["words"])
        self.mask = np.uint64((1 << 64) - (1 << (64 - bits)))
        self.taught = np.repeat(self.train, self.lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        self.second = np.flatnonzero(self.place >= 1)
        first, self.pair_keys, self.pair_counts, self.pair_of = self.grams(
            self.second, self.codes[self.second - 1], self.words
        )
        self.pair_first = first

    def grams(
        self, places: np.ndarray, histories: np.ndarray, names: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (history, word at the place), by key: history, key and training count of each, and which each place has.

        ``names``: hashes of the histories, by number.
        """
        both = (histories.astype(np.uint64) << np.uint64(32)) | self.codes[places].astype(np.uint64)
        distinct, place = np.unique(both, return_inverse=True)
        history, word = (distinct >> np.uint64(32)).astype(np.int64), (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64)
        with np.errstate(over="ignore"):
            keys = mixed(names[history] * FACTOR + self.words[word]) & self.mask
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        counts = np.bincount(place[self.taught[places]], minlength=len(distinct)).astype(np.uint64)
        return history[order], keys[order], counts[order], rank[place]

    def third(self, pair_totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places that two words of a state stand before, and the pair of each."""
        pair_at = np.full(len(self.codes), -1, np.int64)
        pair_at[self.second] = self.pair_of
        places = np.flatnonzero(self.place >= 2)
        pairs = pair_at[places - 1]
        often = pair_totals[pairs] >= LEAST_PAIR
        return places[often], pairs[often]

    def more_keys(
        self, pair_totals: np.ndarray, pair_owned: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What the second exchange is asked: sorted keys, their counts, the place of each word and of each triple
        in them, and which triple each place of ``third`` has."""
        followers = np.bincount(
            self.pair_first[pair_owned & (pair_totals > 0)], minlength=len(self.words)
        ).astype(np.uint64)
        with np.errstate(over="ignore"):
            word_keys = mixed(self.words ^ FOLLOWERS) & self.mask
        _, keys, counts, of = self.grams(*self.third(pair_totals), self.pair_keys)
        every, place = np.unique(np.concatenate([word_keys, keys]), return_inverse=True)
        sums = np.zeros(len(every), np.uint64)
        np.add.at(sums, place, np.concatenate([followers, counts]))
        return every, sums, place[: len(word_keys)], place[len(word_keys) :], of


class Automaton:
    """Root, words and pairs as states, as much of them as a block needs: counts and distinct followers."""

    def __init__(self, tokens: int, kinds: int) -> None:
        self.tokens, self.kinds = tokens, kinds

    def root(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a word at the root."""
        return (counts + 1) / (self.tokens + self.kinds + 1)

    def after_word(self, seen: np.ndarray, state: np.ndarray, followers: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """``seen``: how often the word followed the state; ``state``: how often the state was left."""
        arc = np.maximum(seen - DISCOUNT, 0)
        return np.where(state > 0, (arc + DISCOUNT * followers * shorter) / np.maximum(state, 1), shorter)

    def after_pair(self, seen: np.ndarray, state: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        return (seen + PRIOR * shorter) / (state + PRIOR)

    def read(
        self, block: Block, counts: np.ndarray, pairs: np.ndarray, followers: np.ndarray, triples: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token: at the root alone, and on the way through the states.

        ``counts``, ``followers``: of the block's words; ``pairs``: of its pairs; ``triples``: at each place of ``third``.
        """
        alone = self.root(counts.astype(float))[block.codes]
        there = alone.copy()
        second, history = block.second, block.codes[block.second - 1]
        there[second] = self.after_word(
            pairs[block.pair_of].astype(float),
            counts[history].astype(float),
            followers[history].astype(float),
            alone[second],
        )
        third, state = block.third(pairs)
        there[third] = self.after_pair(triples.astype(float), pairs[state].astype(float), there[third])
        return np.log10(alone), np.log10(there)


ASKED = T.StructType(
    [T.StructField("sender", T.StringType()), *[T.StructField(c, T.BinaryType()) for c in ("keys", "counts")]]
)
CONTENT = ("codes", "lengths", "train", "words")


def pair_requests(blocks: DataFrame, bits: int) -> DataFrame:
    arrow = to_arrow_schema(ASKED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                block = Block(row, bits)
                told = {
                    "sender": row["block"],
                    "keys": pack_sorted(block.pair_keys),
                    "counts": pack(block.pair_counts),
                }
                yield pa.RecordBatch.from_pylist([told], arrow)

    return blocks.select("block", *CONTENT).mapInArrow(run, ASKED)


def more_requests(blocks: DataFrame, pairs: DataFrame, bits: int) -> DataFrame:
    """Followers of words, and words after pairs."""

    def run(key: tuple[str], rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows.iloc[0].to_dict(), bits)
        keys, counts, *_ = block.more_keys(joined(told), owned(told))
        return pd.DataFrame([(key[0], pack_sorted(keys), pack(counts))], columns=ASKED.names)

    given = pairs.select(F.col("sender").alias("to"), "range", "totals")
    return blocks.select("block", *CONTENT).groupBy("block").cogroup(given.groupBy("to")).applyInPandas(run, ASKED)


def distinct_words(told: DataFrame) -> int:
    """How many words were seen in training: each is counted where it is owned."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = [unpack(t, "u8") for t in frame["totals"]]
            yield pd.DataFrame({"n": [int(((v & np.uint64(1)) == 1)[v > 1].sum()) for v in values]})

    return told.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def scored(
    blocks: DataFrame, answers: DataFrame, tokens: int, kinds: int, bits: int, id_type: T.DataType
) -> DataFrame:
    """``answers``: of all three exchanges, told apart by ``of``."""
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("train", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0].to_dict()
        block = Block(row, bits)
        words, pairs, more = (told[told["of"] == k] for k in ("words", "pairs", "more"))
        counts, seen, totals_ = joined(words), joined(pairs), joined(more)
        _, _, word_at, triple_at, of = block.more_keys(seen, owned(pairs))
        alone, there = Automaton(tokens, kinds).read(
            block, counts, seen, totals_[word_at], totals_[triple_at][of]
        )
        return pd.DataFrame(
            {
                "id": pd.Series(list(row["ids"]), dtype=object),
                "train": block.train,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat((counts > 0)[block.codes].astype(np.int64), block.starts),
                "base_score": np.add.reduceat(alone, block.starts),
                "score": np.add.reduceat(there, block.starts),
            }
        )

    both = blocks.select("block", "ids", *CONTENT).groupBy("block")
    given = answers.select(F.col("sender").alias("to"), "range", "totals", "of")
    return both.cogroup(given.groupBy("to")).applyInPandas(run, schema)


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, train, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``train`` says which rows to learn from.
    """
    id_type = docs.schema[doc_id].dataType
    blocks = stored(coded_blocks(docs, doc_id, text, train), "blocks")
    size = blocks.agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("train_tokens").alias("taught"), F.sum("n_tokens").alias("all")
    ).first()
    tokens, every = size["taught"] or 0, size["all"] or 0
    bits = bits_for(every)
    words = totals(
        blocks.select(F.col("block").alias("sender"), F.col("words").alias("keys"), "counts"),
        size["blocks"],
        every // 4,
        "words",
    )
    kinds = distinct_words(words)
    pairs = totals(pair_requests(blocks, bits), size["blocks"], every, "pairs")
    more = totals(more_requests(blocks, pairs, bits), size["blocks"], every, "more")
    answers = reduce(
        DataFrame.unionByName,
        [t.withColumn("of", F.lit(k)) for k, t in (("words", words), ("pairs", pairs), ("more", more))],
    )
    out = scored(blocks, answers, tokens, kinds, bits, id_type)
    return out.withColumnRenamed("id", doc_id).withColumn("train_tokens", F.lit(tokens).cast("long"))
