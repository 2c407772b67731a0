"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is the product of its letters'
vectors, each rotated by its place, and a text is the sum (bundle) of its n-grams, weighted by
how often they occur. A language's prototype is the bundle of its training texts. A text gets the
language with the highest cosine, after the part that all prototypes share is taken away.

Training is a word-count job: n-grams are counted per language within the tasks and summed by
(language, n-gram), so no language and no source meets in one task; the counts become one vector
per language, of which only a few hundred KB reach the driver. Prediction is a map.

Defined results: NULL texts and texts without a letter get ``und`` and score 0; so does
every text if there was nothing to learn from. Of languages with the same cosine the first in
the alphabet is taken. Repeated rows count as often as they occur. Other columns are kept
unless a result has the same name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import cached, slices, small_batches, stored

UNKNOWN = "und"
#: N-gram vectors a worker has at a time, 32 MB of them.
GRAMS_AT_ONCE = 8_192
#: Every task has the prototypes of all languages, so there may not be more of them.
MOST_LANGUAGES = 2_000
#: Tasks that add up n-gram vectors; each returns one vector per language.
VECTOR_TASKS = 16

BITS = 21  # of a code point


@dataclass(frozen=True)
class Space:
    """The random vectors: everything follows from the seed."""

    dims: int = 1024
    n: int = 3
    seed: int = 20240229

    def letter(self, code_point: int) -> np.ndarray:
        def make() -> np.ndarray:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, code_point]))
            return bits.integers(0, 2, self.dims).astype(np.float32) * 2 - 1

        letters = cached(("letters", self), dict)
        if code_point not in letters:
            if len(letters) >= 20_000:
                letters.clear()
            letters[code_point] = make()
        return letters[code_point]

    def ngrams(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of packed n-grams: letters rotated by their place and multiplied."""
        out = np.ones((len(codes), self.dims), np.float32)
        for place in range(self.n):
            points, at = np.unique(
                (codes >> (BITS * (self.n - 1 - place))) & ((1 << BITS) - 1), return_inverse=True
            )
            rolled = np.stack([np.roll(self.letter(int(p)), place) for p in points])
            for start in range(0, len(codes), 1024):
                out[start : start + 1024] *= rolled[at[start : start + 1024]]
        return out


def letters_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def count_ngrams(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, packed n-gram, how often), sorted; n-grams have a letter in the middle.

    Whatever is no letter counts as the boundary 0.
    """
    is_letter = cached("letters", letters_table)
    gap = "\x00" * n
    told = ((gap + (t or "").lower() + gap).encode("utf-32-le") for t in texts)
    points = [np.frombuffer(t, "<u4") for t in told]
    line = np.concatenate(points).astype(np.int64) if points else np.zeros(0, np.int64)
    text_of = np.repeat(np.arange(len(points)), [len(p) for p in points])
    letter = is_letter[line]
    line[~letter] = 0
    middle = np.flatnonzero(letter)
    start = middle - n // 2
    codes = np.zeros(len(start), np.int64)
    for place in range(n):
        codes = (codes << BITS) | line[start + place]
    distinct, small = np.unique(codes, return_inverse=True)
    keys, counts = np.unique(text_of[middle] * len(distinct) + small, return_counts=True)
    if not len(keys):
        return keys, keys, counts
    return keys // len(distinct), distinct[keys % len(distinct)], counts


def count_by_language(docs: DataFrame, text: str, label: str, n: int) -> DataFrame:
    """(lang, gram, n) over all labelled rows, counted within the tasks first."""
    schema = T.StructType.fromDDL("lang string, gram bigint, n bigint")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            names = np.array(part.column("lang").to_pylist(), object)
            texts = part.column("text").to_pylist()
            which, grams, counts = count_ngrams(texts, n)
            langs, lang_of = np.unique(names.astype(str), return_inverse=True)
            order = np.lexsort((grams, lang_of[which]))
            l, g, c = lang_of[which][order], grams[order], counts[order]
            if not len(l):
                continue
            new = np.flatnonzero(np.append(True, (l[1:] != l[:-1]) | (g[1:] != g[:-1])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs[l[new]].tolist(), pa.string()),
                    pa.array(g[new]),
                    pa.array(np.add.reduceat(c, new)),
                ],
                schema=arrow,
            )

    labelled = docs.select(F.col(text).alias("text"), F.col(label).alias("lang"))
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = small_batches(labelled).mapInArrow(run, schema)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_prototypes(
    docs: DataFrame, text: str = "text", label: str = "lang", space: Space = Space()
) -> dict[str, np.ndarray]:
    """One bundle per language, from all given rows that have a label and a text."""
    counts = stored(count_by_language(docs, text, label, space.n), "ngrams")
    languages = counts.agg(F.count_distinct("lang")).first()[0]
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} languages are more than {MOST_LANGUAGES}")
    schema = T.StructType.fromDDL("lang string, vector array<double>")
    arrow = to_arrow_schema(schema)

    def bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, GRAMS_AT_ONCE):
                part = batch.slice(start, GRAMS_AT_ONCE)
                langs = np.array(part.column("lang").to_pylist())
                vectors = space.ngrams(part.column("gram").to_numpy())
                n = part.column("n").to_numpy().astype(np.float64)
                for lang in np.unique(langs):
                    mine = langs == lang
                    sums.setdefault(str(lang), np.zeros(space.dims))
                    sums[str(lang)] += n[mine] @ vectors[mine]
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])],
                schema=arrow,
            )

    found: dict[str, np.ndarray] = {}
    rows = counts.coalesce(VECTOR_TASKS).mapInArrow(bundle, schema).collect()
    for row in sorted(rows, key=lambda r: (r["lang"], r["vector"])):
        found[row["lang"]] = found.get(row["lang"], 0) + np.array(row["vector"])
    return found


def centred(prototypes: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, unit vectors without the languages' mean, and that mean (of unit vectors)."""
    names = sorted(prototypes)
    unit = np.stack([prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-12) for k in names])
    mean = unit.mean(axis=0) if len(names) > 1 else np.zeros(unit.shape[1])
    away = unit - mean
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    return names, away.astype(np.float32), mean.astype(np.float32)


def predict(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    text: str = "text",
    space: Space = Space(),
    lang_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """Adds the predicted language and its score, (1 + cosine) / 2; 0 for ``und``."""
    added = [T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    taken = {lang_name.lower(), score_name.lower()}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType(kept + added)
    arrow = to_arrow_schema(schema)
    model = centred(prototypes) if prototypes else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            n = part.num_rows
            langs, scores = [UNKNOWN] * n, [0.0] * n
            which, grams, counts = count_ngrams(part.column(text).to_pylist(), space.n)
            if model and len(which):
                names, away, mean = model
                for i, bundle in bundles(which, grams, counts, space):
                    rest = bundle / max(float(np.linalg.norm(bundle)), 1e-12) - mean
                    rest /= max(float(np.linalg.norm(rest)), 1e-12)
                    cosines = np.round(away @ rest, 6)
                    best = int(np.argmax(cosines))
                    langs[i], scores[i] = names[best], (1 + float(cosines[best])) / 2
            columns = {f.name: part.column(f.name) for f in kept}
            columns[lang_name] = pa.array(langs, pa.string())
            columns[score_name] = pa.array(np.clip(scores, 0.0, 1.0))
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in arrow], schema=arrow)

    return small_batches(docs).select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)


def lettered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter, whatever there is to learn from."""
    arrow = to_arrow_schema(docs.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            has = [any(c.isalpha() for c in t or "") for t in part.column(text).to_pylist()]
            kept = part.filter(pa.array(has, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, schema=arrow)

    return small_batches(docs).mapInArrow(run, docs.schema)


def bundles(
    which: np.ndarray, grams: np.ndarray, counts: np.ndarray, space: Space
) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, bundle) of every text with an n-gram; ``which`` is sorted.

    Texts share the vectors of their n-grams. Texts with more different ones than fit are
    halved, and a single text of that kind is added up piece by piece.
    """
    distinct, at = np.unique(grams, return_inverse=True)
    first = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    if len(distinct) > GRAMS_AT_ONCE:
        if len(first) > 1:
            cut = first[len(first) // 2]
            yield from bundles(which[:cut], grams[:cut], counts[:cut], space)
            yield from bundles(which[cut:], grams[cut:], counts[cut:], space)
        else:
            pieces = range(0, len(grams), GRAMS_AT_ONCE)
            parts = (slice(p, p + GRAMS_AT_ONCE) for p in pieces)
            added = [counts[p].astype(np.float32) @ space.ngrams(grams[p]) for p in parts]
            yield int(which[0]), np.sum(added, axis=0)
        return
    vectors = space.ngrams(distinct)
    for a, b in zip(first, np.append(first[1:], len(which)), strict=True):
        yield int(which[a]), counts[a:b].astype(np.float32) @ vectors[at[a:b]]


def held_out_rows(doc_id: Column | str = "doc_id", folds: int = 5) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text is divisible by ``folds``."""
    as_text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(as_text.cast("binary")) % folds == 0
