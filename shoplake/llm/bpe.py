"""Byte-level BPE: speculate greedily, verify adjacent pairs, merge exactly only where that fails.

A sequence of tokens is the BPE encoding of its bytes exactly when every token is its own
encoding and no merge across a border of two neighbours comes before the merges that made
them. So the longest matches of the vocabulary are proposed for all new words of a slice at
once, the distinct neighbour pairs are tested with array operations, and only words with a
failing pair go through the merge list. Nothing is shuffled: a document is encoded where it
is read.

Defined results: NULL text encodes as empty text; ids and text of an empty document are empty;
rows are independent, so repeated rows give repeated results. Columns other than the text are
kept, except those with the names of the results, which are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from typing import Any

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import cached, slices, small_batches

#: Bytes of words kept with their ids by one worker, about; beyond it the worker starts afresh. Texts without blanks are
#: single words of any length, so bytes are counted, not words.
CACHED_BYTES = 48 * 1024 * 1024
#: What a word takes beside its letters, and what each letter takes with its share of the ids.
WORD_BYTES, LETTER_BYTES = 150, 6
#: A tokenizer file is a few MB; anything beyond this isn't one and is not broadcast.
MAX_FILE_BYTES = 64 * 1024 * 1024

# The public byte-level pre-tokenisation pattern, and letters and numbers that
# are newer than the Unicode version (16.0) that the tokenizers library counts with.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[[^\s\p{{L}}\p{{N}}]{newer}]+|\s+(?!\S)|\s+"
)
NEWER = (
    "0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 "
    "A7D4-A7D4 A7DD-A7DD A7E2-A7E2 A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9 11DF1-11DF1 1246F-1246F 12475-1247F "
    "12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 "
    "18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 "
    "1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)

#: Words of more bytes are merged one by one, with a heap.
LONG_WORD = 64

#: Stands between words in one long string; no byte of a word maps to it.
GAP = "￿"


def word_patterns() -> tuple[Any, Any, Any]:
    """The usual pattern, the exact one, and a test for characters that need the exact one."""
    newer = "".join(
        "\\U{:0>8}-\\U{:0>8}".format(*span.split("-")) for span in NEWER.split()
    )
    usual = PATTERN.format(L=r"\p{L}", N=r"\p{N}", newer="")
    exact = PATTERN.format(
        L=rf"[\p{{L}}--[{newer}]]", N=rf"[\p{{N}}--[{newer}]]", newer=f"[{newer}]"
    )
    return (
        regex.compile(usual, regex.V1),
        regex.compile(exact, regex.V1),
        regex.compile(f"[{newer}]"),
    )


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Vocabulary, merges and special tokens of one byte-level tokenizer file."""

    def __init__(self, file: bytes) -> None:
        spec = json.loads(file)
        letters = byte_letters()
        self.ids = {
            bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
        }
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = [tuple(self.ids[bytes(letters[c] for c in side)] for side in m) for m in merges]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for token, i in [*self.ids.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.token_bytes[i] = token
        self.byte_id = [self.ids[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(pairs):
            made = self.ids[self.token_bytes[pair[0]] + self.token_bytes[pair[1]]]
            self.merges.setdefault(pair, (rank, made))
        # the merge that makes a token when it is encoded alone, and its two sides
        self.size, never = size, len(pairs)
        self.made_at = np.full(size, -1, np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        for (a, b), (rank, made) in self.merges.items():
            if self.made_at[made] < 0:
                self.made_at[made], self.left[made], self.right[made] = rank, a, b
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_rank = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.pair_made = np.array([m for _, m in self.merges.values()], np.int64)[order]
        self.byte_ids = np.array(self.byte_id)
        self.never = never
        own = [t for t, i in self.ids.items() if self.merged(t) == [i]]
        self.longest = ahocorasick.Automaton()
        for token in own:
            self.longest.add_word(token.decode("latin-1"), self.ids[token])
        self.longest.make_automaton()
        self.usual, self.exact, self.newer = word_patterns()
        self.parts = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.known: dict[str, bytes] = {
            t: np.array([i], "<u4").tobytes() for t, i in self.special.items()
        }
        self.fixed = dict(self.known)
        self.held = 0
        self.merged_words = 0

    def merged(self, word: bytes) -> list[int]:
        """The exact encoding: repeat the earliest merge, leftmost first."""
        ids = [self.byte_id[b] for b in word]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def merged_together(self, words: list[bytes]) -> list[bytes]:
        """As ``merged`` for many short words: in each round every word makes its next merge."""
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word_of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            keys = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = (self.pair_keys[at] == keys) & (word_of[1:] == word_of[:-1])
            rank = np.append(np.where(hit, self.pair_rank[at], self.never), self.never)
            starts = np.flatnonzero(np.append(True, word_of[1:] != word_of[:-1]))
            sizes = np.diff(np.append(starts, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            ended = least == self.never
            if ended.any():
                done.append((word_of[ended], ids[ended]))
            here = np.flatnonzero((rank == least) & ~ended)
            here = here[np.append(True, word_of[here][1:] != word_of[here][:-1])] if len(here) else here
            ids[here] = self.pair_made[at[here]]
            keep = ~ended
            keep[here + 1] = False
            ids, word_of = ids[keep], word_of[keep]
        word_of = np.concatenate([w for w, _ in done])
        order = np.argsort(word_of, kind="stable")
        packed = np.concatenate([i for _, i in done])[order].astype("<u4").tobytes()
        cut = (4 * np.searchsorted(word_of[order], np.arange(len(words) + 1))).tolist()
        return [packed[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For arrays of neighbours: whether no merge over the border comes first.

        Along the border lie the right edge of ``a`` and the left edge of ``b``. A merge of one
        part of each happens if it is earlier than the merges that use these parts up; at
        the same rank the one further left is first.
        """
        good = np.ones(len(a), bool)
        x, x_used = a.copy(), np.full(len(a), self.never + 1)
        while True:
            y, y_used = b.copy(), np.full(len(a), self.never + 1)
            while True:
                at = np.minimum(
                    np.searchsorted(self.pair_keys, x * self.size + y), len(self.pair_keys) - 1
                )
                rank = np.where(
                    self.pair_keys[at] == x * self.size + y, self.pair_rank[at], self.never + 2
                )
                good &= ~((rank < x_used) & (rank <= y_used))
                inner = self.left[y]
                if (inner == y).all():
                    break
                y_used = np.where(inner != y, self.made_at[y], y_used)
                y = inner
            inner = self.right[x]
            if (inner == x).all():
                return good
            x_used = np.where(inner != x, self.made_at[x], x_used)
            x = inner

    def learn(self, words: list[str]) -> None:
        """Add the ids of new words to ``known``."""
        raw = [w.encode() for w in words]
        line = GAP.join(w.decode("latin-1") for w in raw)
        ends, ids = (np.array(x) for x in zip(*self.longest.iter_long(line), strict=True))
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        word_ends = np.cumsum(lengths + 1) - 2  # last character of each word in the line
        word_of = np.searchsorted(word_ends, ends)
        covered = np.bincount(
            word_of, self.token_lengths()[ids], minlength=len(raw)
        ).astype(np.int64)
        bad = covered != lengths  # a proposal must spell its whole word
        same = word_of[1:] == word_of[:-1]
        pairs, where = np.unique(
            (ids[:-1] * self.size + ids[1:])[same], return_inverse=True
        )
        if len(pairs):
            good = self.compatible(pairs // self.size, pairs % self.size)
            bad[word_of[1:][same][~good[where]]] = True
        first = np.searchsorted(word_of, np.arange(len(raw) + 1))
        packed = ids.astype("<u4").tobytes()
        cut = (4 * first).tolist()
        self.known.update(
            zip(words, [packed[a:b] for a, b in zip(cut, cut[1:], strict=False)], strict=True)
        )
        failing = np.flatnonzero(bad)
        self.merged_words += len(failing)
        short = [k for k in failing.tolist() if lengths[k] <= LONG_WORD]
        for k in set(failing.tolist()).difference(short):
            self.known[words[k]] = np.array(self.merged(raw[k]), "<u4").tobytes()
        if short:
            merged = self.merged_together([raw[k] for k in short])
            self.known.update(zip([words[k] for k in short], merged, strict=True))

    def token_lengths(self) -> np.ndarray:
        if not hasattr(self, "_lengths"):
            self._lengths = np.array([len(t) for t in self.token_bytes])
        return self._lengths

    def words(self, text: str) -> list[str]:
        pattern = self.usual if is_latin(text) or not self.newer.search(text) else self.exact
        if not any(s in text for s in self.special):
            return pattern.findall(text)
        found = []
        for part in self.parts.split(text):
            found += [part] if part in self.special else pattern.findall(part)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.words(t) for t in texts]
        used = set().union(*cut)
        new = list(used - self.known.keys())
        if new:
            self.learn(new)
            self.held += WORD_BYTES * len(new) + LETTER_BYTES * sum(map(len, new))
        known = self.known
        if self.held > CACHED_BYTES:
            self.known, self.held = dict(self.fixed), 0
        return [b"".join([known[w] for w in ws]) for ws in cut]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        table = self.token_bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", errors="replace")


def is_latin(text: str) -> bool:
    """A quick test that spares most texts the search for rare characters."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def read_tokenizer(path: str) -> bytes:
    with open(path, "rb") as file:
        content = file.read(MAX_FILE_BYTES + 1)
    if len(content) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than a tokenizer file")
    return content


def encode_decode(
    docs: DataFrame, tokenizer_path: str, text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """Encode every text and decode the ids again.

    Adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``keep_ids``, ``token_ids``
    (array of int) and ``decoded``. The tokenizer file is read on the driver, checked for size and
    broadcast.
    """
    content = read_tokenizer(tokenizer_path)
    key = hashlib.sha256(content).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(content)
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType())]
    added += [T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        added += [
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    names = {f.name.lower() for f in added}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    wanted = docs.select(*[f"`{f.name}`" for f in kept])
    schema = T.StructType(kept + added)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = cached(("bpe", key), lambda: Codec(shared.value))
        for part in slices(batches, text):
            texts = [t or "" for t in part.column(text).to_pylist()]
            packed = codec.encode(texts)
            decoded = [codec.decode(p) for p in packed]
            columns = {f.name: part.column(f.name) for f in kept}
            columns["n_tokens"] = pa.array([len(p) // 4 for p in packed], pa.int64())
            columns["ids_sha256"] = pa.array([hashlib.sha256(p).hexdigest() for p in packed])
            columns["decoded_sha256"] = pa.array(
                [hashlib.sha256(d.encode()).hexdigest() for d in decoded]
            )
            if keep_ids:
                flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])
                columns["token_ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                columns["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) for f in arrow], schema=arrow
            )

    return small_batches(wanted).mapInArrow(run, schema)
