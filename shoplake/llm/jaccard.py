"""N-gram Jaccard self-join: MinHash banding proposes, full n-gram sets decide.

1. A map turns each text into the set of its word 5-grams (64-bit hashes), a 128-bit name of the
   set, and one 64-bit value per band. Band and row counts follow from the threshold and
   the recall wanted at it (``plan_bands``).
2. Equal sets collapse to one row with a count, so exact copies are never compared.
3. Sets are shuffled by band value. Buckets of one are dropped before anything else moves.
4. Sets of a bucket larger than ``CHUNK`` are first held against a centre, the n-grams that most of some
   members have. Those within half of the allowed distance of it are a *core*: the Jaccard
   distance is a metric, so any two of them are linked, and their links are counted without looking at pairs.
   Centres only save work; no result depends on which they are.
5. What is left of a large bucket is dealt to chunks, and each pair of chunks is a group of its own. The chunks of
   one core do not meet each other.
6. A pair is looked at only in the first band it shares, so it counts once. Only sets with such a
   partner fetch their n-grams, and each group counts the verified links of its members. What
   leaves a group is one row per member: its number of links, and the least member it
   is tied to. Pairs are never written out.
7. Components of these ties are classes; class id is the least document id.

A bucket of near copies of one text therefore moves in proportion to its sets. Counting links exactly takes a
comparison for each pair of *different* sets that share a bucket but no core, so the work still grows with
the square of those. No task or group grows with the bucket.

Words are runs of ASCII letters and digits and of any other characters, A-Z lower-cased. A text of fewer
than five words is one n-gram of all its words. Defined results: NULL, empty and wordless texts
have no set, no links and are their own class; rows with equal texts have equal classes, also
if the id repeats; ids that are NULL count last when the least id of a class is taken, and a
class of NULL ids only has a NULL id. Extra columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import bins_for, join_small, slices, small_batches, stored, under_private_names
from shoplake.llm.components import components
from shoplake.llm.decontaminate import words_of

N = 5
THRESHOLD = 0.8
#: Chance that a pair just at the threshold shares a band.
RECALL = 0.9995
MOST_HASHES = 128
#: Sets of one bucket that are compared in one group.
CHUNK = 512
#: Members that a centre is made of, about.
PIVOTS = 32
#: Share of the sets it looks at that a round of cores must place for another one to follow.
WORTHWHILE = 0.1
#: Rows of one Python group in the search for partners, and bytes in the verification.
BIN_ROWS, BIN_BYTES = 5_000, 8 * 1024 * 1024
#: Bytes of a matrix while links are counted.
MATRIX_BYTES = 32 * 1024 * 1024

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def plan_bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall within the budget."""
    best = (most, 1)
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = [words_of(t) for t in texts]
    places: dict[bytes, int] = {}
    codes = [[places.setdefault(w, len(places)) for w in ws] for ws in words]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, places), np.uint64, len(places))
    out = []
    with np.errstate(over="ignore"):
        for cs in codes:
            h = hashes[np.array(cs, np.int64)] if cs else np.zeros(0, np.uint64)
            size = min(n, len(h))
            grams = np.full(max(len(h) - size + 1, 0) if size else 0, size, np.uint64)
            for k in range(size):
                grams = grams * FACTOR + h[k : k + len(grams)]
            out.append(np.unique(mixed(grams)))
    return out


def band_values(sets: list[np.ndarray], bands: int, rows: int, seed: int = 7) -> np.ndarray:
    """One number per set and band; equal sets have equal numbers, similar sets often."""
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sets), bands), np.uint64)
    if not len(full):
        return out
    line = np.concatenate([sets[i] for i in full])
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    random = np.random.Generator(np.random.Philox(seed))
    salts = random.integers(0, 1 << 63, (bands, rows, 2), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            value = np.full(len(full), b + 1, np.uint64)
            for r in range(rows):
                least = np.minimum.reduceat(
                    (line ^ salts[b, r, 0]) * (salts[b, r, 1] | np.uint64(1)), starts
                )
                value = mixed(value * FACTOR + least)
            out[full, b] = value
    return out


def as_set(grams: np.ndarray) -> tuple[bytes | None, bytes]:
    raw = grams.tobytes()
    return (xxhash.xxh3_128_digest(raw) if raw else None), raw


def signatures(docs: DataFrame, doc_id: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """(id, set_key, n_grams, bands) of every row."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("n_grams", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = gram_sets(part.column("text").to_pylist(), n)
            values = band_values(sets, bands, rows).view(np.int64)
            ends = pa.array(np.arange(len(sets) + 1) * bands, pa.int32())
            columns = [
                part.column("id"),
                pa.array([as_set(s)[0] for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(values.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

    texts = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return texts.mapInArrow(run, schema)


def fetched(docs: DataFrame, doc_id: str, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """(set_key, grams) of the wanted sets, from the texts of their documents."""
    schema = T.StructType.fromDDL("set_key binary, grams binary")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            pairs = [as_set(s) for s in gram_sets(part.column("text").to_pylist(), n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in pairs], pa.binary()), pa.array([g for _, g in pairs], pa.binary())],
                schema=arrow,
            )

    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    ids = stored(wanted.select(F.col("rep").alias("wanted_id")).distinct(), "wanted")
    known = ids.where(F.col("wanted_id").isNotNull())
    picked = join_small(source, known.select(F.col("wanted_id").alias("id")), ["id"], "left_semi")
    if ids.where(F.col("wanted_id").isNull()).count():
        picked = picked.unionByName(source.where(F.col("id").isNull()))
    return picked.mapInArrow(run, schema).distinct()


def fresh_pairs(a: np.ndarray, b: np.ndarray, band: int) -> np.ndarray:
    """For band values of two lists of sets: pairs that share no band before this one."""
    out = np.ones((len(a), len(b)), bool)
    for k in range(band):
        out &= a[:, k][:, None] != b[:, k][None, :]
    return out


def groups_in(frame: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """(start, end) of the rows of each group in a frame sorted by band, i, j."""
    key = frame[["band", "i", "j"]].to_numpy()
    new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))) if len(key) else []
    yield from zip(new, np.append(new[1:], len(key)).astype(int), strict=True) if len(new) else ()


def sides(i: int, j: int, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row places of the two chunks of a group; the same rows twice if it is one chunk."""
    if i == j:
        rows = np.arange(len(mine))
        return rows, rows
    return np.flatnonzero(mine == i), np.flatnonzero(mine == j)


def partners(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows that have a partner outside their core whose first shared band is this one."""
    frame = frame.sort_values(["band", "i", "j", "set_key"], ignore_index=True)
    keep = np.zeros(len(frame), bool)
    values = np.stack(frame["bands"].to_numpy()) if len(frame) else np.zeros((0, 1))
    unit = pd.factorize(frame["unit"])[0]
    mine, i, j = (frame[c].to_numpy() for c in ("mine", "i", "j"))
    band_no = frame["band_no"].to_numpy()
    for a, b in groups_in(frame):
        left, right = sides(i[a], j[a], mine[a:b])
        for s in range(0, len(left), 256):
            rows = left[s : s + 256]
            fresh = fresh_pairs(values[a + rows], values[a + right], band_no[a])
            fresh &= unit[a + rows][:, None] != unit[a + right][None, :]
            keep[a + rows[fresh.any(axis=1)]] = True
            keep[a + right[fresh.any(axis=0)]] = True
    return frame.loc[keep, ["band", "band_no", "i", "j", "mine", "set_key", "n_grams"]]


def similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """For two lists of sets: which pairs have a Jaccard similarity of at least the threshold.

    Shared n-grams are counted by multiplying 0/1 matrices, some columns at a time. N-grams
    that one set has alone never count and get no column.
    """
    sizes_l = np.array([len(s) for s in left])
    sizes_r = np.array([len(s) for s in right])
    line_l, line_r = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(line_l, line_r)
    shared = np.zeros((len(left), len(right)), np.float32)

    def places(line: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, line), max(len(both) - 1, 0))
        ok = both[at] == line if len(both) else np.zeros(len(line), bool)
        return np.repeat(np.arange(len(sizes)), sizes)[ok], at[ok]

    row_l, col_l = places(line_l, sizes_l)
    row_r, col_r = places(line_r, sizes_r)
    width = max(64, MATRIX_BYTES // (4 * (len(left) + len(right))))
    for start in range(0, len(both), width):
        wide = min(width, len(both) - start)
        m_l = np.zeros((len(left), wide), np.float32)
        m_r = np.zeros((len(right), wide), np.float32)
        for m, row, col in ((m_l, row_l, col_l), (m_r, row_r, col_r)):
            inside = (col >= start) & (col < start + wide)
            m[row[inside], col[inside] - start] = 1
        shared += m_l @ m_r.T
    union = sizes_l[:, None] + sizes_r[None, :] - shared
    return (shared >= threshold * union - 1e-6) & (shared > 0)


def linker(threshold: float) -> object:
    """A function that counts the verified links of each member of each group."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["band", "i", "j", "set_key"], ignore_index=True)
        keys = frame["set_key"].to_numpy()
        copies = frame["copies"].to_numpy()
        mine, i, j = (frame[c].to_numpy() for c in ("mine", "i", "j"))
        band_no = frame["band_no"].to_numpy()
        unit = pd.factorize(frame["unit"])[0]
        found: list[tuple[bytes, bytes, int, int]] = []
        for a, b in groups_in(frame):
            left, right = sides(i[a], j[a], mine[a:b])
            sets = [np.frombuffer(g, np.uint64) for g in frame["grams"].iloc[a:b]]
            values = np.stack(frame["bands"].iloc[a:b].to_numpy())
            docs = np.zeros(b - a, np.int64)
            others = np.zeros(b - a, np.int64)
            root = np.arange(b - a)
            for s in range(0, len(left), 256):
                rows = left[s : s + 256]
                linked = similar([sets[k] for k in rows], [sets[k] for k in right], threshold)
                linked &= fresh_pairs(values[rows], values[right], band_no[a])
                linked &= unit[a + rows][:, None] != unit[a + right][None, :]
                docs[rows] += linked @ copies[a:b][right]
                others[rows] += linked.sum(axis=1)
                if i[a] != j[a]:
                    docs[right] += copies[a:b][rows] @ linked
                    others[right] += linked.sum(axis=0)
                join_rows(root, rows, right, linked)
            for k in np.flatnonzero(others):
                found.append((keys[a + k], keys[a + top(root, k)], int(docs[k]), int(others[k])))
        return pd.DataFrame(found, columns=["set_key", "peer", "docs", "others"])

    return run


def top(root: np.ndarray, k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return int(k)


def join_rows(root: np.ndarray, rows: np.ndarray, right: np.ndarray, linked: np.ndarray) -> None:
    """Unite linked rows; the least row of a component is its root."""
    for r, line in zip(rows, linked, strict=True):
        ends = right[line]
        if len(ends):
            tops = {top(root, int(r))} | {top(root, int(e)) for e in np.unique(root[ends])}
            least = min(tops)
            for t in tops:
                root[t] = least


def majority(frame: pd.DataFrame) -> pd.DataFrame:
    """The n-grams that more than half of the given sets have."""
    line = np.concatenate([np.frombuffer(g, np.uint64) for g in frame["grams"]])
    grams, n = np.unique(line, return_counts=True)
    return pd.DataFrame({"home": frame["home"].iloc[:1], "centre": [grams[2 * n > len(frame)].tobytes()]})


def around(rows: DataFrame, threshold: float) -> DataFrame:
    """(set_key, home) of the rows (set_key, home, grams, centre) within half of the allowed distance of their centre."""
    schema = T.StructType.fromDDL("set_key binary, home long")
    arrow = to_arrow_schema(schema)
    least = (1 + threshold) / 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = []
            for mine, centre in zip(batch.column("grams"), batch.column("centre"), strict=True):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (mine, centre))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                close.append(shared > 0 and shared >= least * (len(a) + len(b) - shared))
            kept = batch.select(["set_key", "home"]).filter(pa.array(close, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, schema=arrow)

    return rows.select("set_key", "home", "grams", "centre").mapInArrow(run, schema)


def cores(large: DataFrame, sets: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """(set_key, unit, docs, others) of the sets in a core of at least two: the least set of the core, and the links inside it.

    ``large`` has the rows (band, set_key) of large buckets. The largest bucket of a set is its home. A set tries the
    centre of the home that leads each of its buckets, which is the home of most members there, and joins
    the core that most sets are near to: near copies of one text meet in one core, whichever bands they
    share. Rounds go on with what is left of the buckets while they find enough.
    """
    found = None
    left = large.select("band", "set_key")
    while True:
        crowded = left.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
        here = stored(join_small(left, stored(crowded, "crowded"), ["band"], "inner"), "here")
        home = here.groupBy("set_key").agg(F.max(F.struct("n", "band")).alias("best"))
        home = stored(home.select("set_key", F.col("best.band").alias("home")), "homes")
        votes = here.join(home, "set_key").groupBy("band", "home").agg(F.count("*").alias("votes"))
        lead = votes.groupBy("band").agg(F.max(F.struct("votes", "home")).alias("best"))
        lead = stored(lead.select("band", F.col("best.home").alias("home")), "lead")
        members = home.groupBy("home").agg(F.count("*").alias("members"))
        members = stored(members.join(lead.select("home").distinct(), "home", "left_semi"), "members")
        one_of = F.ceil(F.col("members") / PIVOTS).cast("int")
        pivots = join_small(home, members, ["home"], "inner")
        pivots = pivots.where(F.pmod(F.xxhash64(F.lit("pivot"), "set_key"), one_of) == 0).join(grams, "set_key")
        centres = pivots.select("home", "grams").groupBy("home").applyInPandas(majority, "home long, centre binary")
        tried = join_small(here, lead, ["band"], "inner").select("set_key", "home").distinct()
        rows = join_small(tried.join(grams, "set_key"), stored(centres, "centres"), ["home"], "inner")
        near = stored(around(rows, threshold), "near")
        sizes = stored(near.groupBy("home").agg(F.count("*").alias("size")), "sizes")
        chosen = join_small(near, sizes, ["home"], "inner").groupBy("set_key")
        chosen = chosen.agg(F.max(F.struct("size", "home")).alias("best"))
        chosen = chosen.select("set_key", F.col("best.home").alias("home"))
        chosen = stored(chosen.join(sets.select("set_key", "copies"), "set_key"), "chosen")
        core = chosen.groupBy("home").agg(
            F.min("set_key").alias("unit"), F.count("*").alias("n_sets"), F.sum("copies").alias("n_docs")
        )
        placed = join_small(chosen, stored(core.where(F.col("n_sets") > 1), "cores"), ["home"], "inner").select(
            "set_key",
            "unit",
            (F.col("n_docs") - F.col("copies")).alias("docs"),
            (F.col("n_sets") - 1).alias("others"),
        )
        placed = stored(placed, "placed")
        found = placed if found is None else found.unionByName(placed)
        n_placed = placed.count()
        if not n_placed or n_placed < WORTHWHILE * home.count():
            return found
        left = stored(left.join(placed.select("set_key"), "set_key", "left_anti").select("band", "set_key"), "left")
        if left.groupBy("band").count().where(F.col("count") > CHUNK).isEmpty():
            return found


def laid_out(hits: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Adds to (band, band_no, set_key, n) the chunks of each member: the first of its part, how many that part and
    the bucket have, and whether the part's chunks skip each other, because one core fills it.

    A core with ``CHUNK`` members in a bucket has chunks of its own there; all other members share chunks.
    """
    whole = hits.select("*", F.lit(0).alias("first"), F.lit(1).alias("own"), F.lit(1).alias("total"), F.lit(False).alias("alone"))
    if units is None:
        return whole
    small = whole.where(F.col("n") <= CHUNK)
    known = hits.where(F.col("n") > CHUNK).join(units.select("set_key", "unit"), "set_key")
    counted = known.groupBy("band", "unit").agg(F.count("*").alias("members"))
    full = stored(counted.where(F.col("members") >= CHUNK), "full")
    part = F.coalesce("part", F.lit(b""))
    dealt = join_small(known, full.select("band", "unit", F.col("unit").alias("part")), ["band", "unit"], "left")
    dealt = dealt.drop("unit").withColumn("part", part)
    sizes = stored(dealt.groupBy("band", "part").agg(F.count("*").alias("members")), "parts")
    chunks = sizes.select("band", "part", F.ceil(F.col("members") / CHUNK).cast("int").alias("own"))
    bucket = W.partitionBy("band")  # as many rows as the bucket has parts
    before = bucket.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    layout = chunks.select(
        "band",
        "part",
        F.coalesce(F.sum("own").over(before), F.lit(0)).cast("int").alias("first"),
        "own",
        F.sum("own").over(bucket).cast("int").alias("total"),
        (F.col("part") != F.lit(b"")).alias("alone"),
    )
    large = join_small(dealt, stored(layout, "layout"), ["band", "part"], "inner").drop("part")
    return small.unionByName(large)


def spread(hits: DataFrame) -> DataFrame:
    """Deal the members of buckets to chunks: a row for each pair of chunks that a member is in."""
    mine = F.col("first") + F.pmod(F.xxhash64("set_key"), F.col("own")).cast("int")
    chunks = F.sequence(F.lit(0), F.col("total") - 1)
    foreign = F.filter(chunks, lambda c: (c < F.col("first")) | (c >= F.col("first") + F.col("own")))
    # a chunk meets itself and every other one, but none of its own core
    met = F.when(F.col("alone"), foreign).otherwise(chunks)
    dealt = hits.withColumn("mine", mine).withColumn("other", F.explode(met))
    return dealt.select(
        "band",
        "band_no",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        "mine",
        "set_key",
    )


def binned(rows: DataFrame, bins: int) -> DataFrame:
    return rows.withColumn("bin", F.pmod(F.xxhash64("band", "i", "j"), F.lit(bins)).cast("int"))


MEMBER = "band long, band_no int, i int, j int, mine int, set_key binary, n_grams long"


def links(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored tables: rows (id, set_key, n_grams), sets (set_key, bands, rep, copies, n_grams), and
    verified (set_key, peer, docs, others), which has one row per set and group it has links in."""
    bands, rows = plan_bands(threshold, recall)
    signed = stored(signatures(docs, doc_id, text, n, bands, rows), "signatures")
    sets = (
        signed.where(F.col("set_key").isNotNull())
        .groupBy("set_key", "bands")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.max("n_grams").alias("n_grams"))
    )
    sets = stored(sets, "sets")
    each = sets.select("set_key", F.posexplode("bands").alias("band_no", "band"))
    crowded = each.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    hits = stored(each.join(crowded, "band"), "hits")
    large = hits.where(F.col("n") > CHUNK)
    if large.isEmpty():
        inside, units = None, sets.withColumn("unit", F.col("set_key"))
        dealt = laid_out(hits)
    else:
        asked = sets.join(large.select("set_key").distinct(), "set_key", "left_semi")
        inside = cores(large, sets, stored(fetched(docs, doc_id, text, n, asked), "grams"), threshold)
        units = sets.join(inside.select("set_key", "unit"), "set_key", "left")
        units = stored(units.withColumn("unit", F.coalesce("unit", "set_key")), "units")
        dealt = stored(laid_out(hits, units), "dealt")
    met = F.col("total") - F.when(F.col("alone"), F.col("own")).otherwise(0)
    n_dealt = dealt.agg(F.sum(met)).first()[0] or 0  # rows after spread()
    candidates = spread(dealt).join(units.select("set_key", "bands", "n_grams", "unit"), "set_key")
    needs = stored(
        binned(candidates, bins_for(n_dealt, BIN_ROWS)).groupBy("bin").applyInPandas(partners, MEMBER),
        "needs",
    )
    wanted = sets.join(needs.select("set_key").distinct(), "set_key", "left_semi")
    grams = fetched(docs, doc_id, text, n, wanted)
    size = needs.agg(F.sum(8 * F.col("n_grams") + 300)).first()[0] or 0
    members = (
        binned(needs, bins_for(size, BIN_BYTES))
        .join(units.select("set_key", "bands", "copies", "unit"), "set_key")
        .join(grams, "set_key")
    )
    verified = members.groupBy("bin").applyInPandas(
        linker(threshold), "set_key binary, peer binary, docs long, others long"
    )
    verified = stored(verified, "links")
    if inside is not None:
        verified = verified.unionByName(inside.select("set_key", F.col("unit").alias("peer"), "docs", "others"))
    return signed.select("id", "set_key", "n_grams"), sets, verified


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings: float) -> DataFrame:
    """One row per document: id, set_key, class_key, class_id, n_links (documents) and n_text_links (different sets).

    Documents with an equal set are linked to each other too.
    """
    rows, sets, verified = links(docs, doc_id, text, **settings)
    roots = components(verified.select(F.col("set_key").alias("u"), F.col("peer").alias("v")))
    placed = sets.select("set_key", "rep", "copies").join(
        roots.withColumnRenamed("node", "set_key"), "set_key", "left"
    )
    placed = placed.withColumn("root", F.coalesce("root", "set_key"))
    least = placed.groupBy("root").agg(F.min("rep").alias("class_id"))
    counts = verified.groupBy("set_key").agg(F.sum("docs").alias("docs"), F.sum("others").alias("others"))
    told = placed.join(least, "root").join(counts, "set_key", "left").select(
        "set_key",
        F.col("root").alias("class_key"),
        "class_id",
        (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("others", F.lit(0)).cast("long").alias("n_text_links"),
    )
    told = stored(told, "classes")
    none = F.lit(0).cast("long")
    return rows.join(told, "set_key", "left").select(
        F.col("id").alias(doc_id),
        "set_key",
        "class_key",
        F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", none).alias("n_links"),
        F.coalesce("n_text_links", none).alias("n_text_links"),
        "n_grams",
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings: float) -> DataFrame:
    """The documents without those that are in the class of a document with a lesser id.

    If the least id of a class has several rows, the one with the least text stays, then the
    least of the other columns. Documents without words stay. The given columns may have any names.
    """
    return under_private_names(docs, [doc_id, text], lambda rows, i, t: _one_of_each(rows, i, t, **settings))


def _one_of_each(docs: DataFrame, doc_id: str, text: str, **settings: float) -> DataFrame:
    told = classes(docs, doc_id, text, **settings)
    wordy = told.where(F.col("set_key").isNotNull())
    extra = wordy.where(~F.col(doc_id).eqNullSafe(F.col("class_id"))).select(doc_id, "class_id")
    again = (  # an id may have wordless rows too
        told.groupBy(doc_id)
        .agg(F.count("*").alias("n"))
        .where((F.col("n") > 1) | F.col(doc_id).isNull())
        .select(doc_id)
    )
    extra, again = stored(extra, "extra"), stored(again, "again")
    dropped = extra.where(F.col(doc_id).isNotNull()).select(doc_id).distinct()
    if not again.count():
        return join_small(docs, dropped, [doc_id], "left_anti")
    return _with_repeats(docs, told, again, dropped, doc_id, text)


def keyed(docs: DataFrame, text: str, n: int = N) -> DataFrame:
    """Adds ``_set``, the name of each row's set."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_set", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            names = [as_set(s)[0] for s in gram_sets(part.column(text).to_pylist(), n)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.binary())], schema=arrow)

    return docs.mapInArrow(run, schema)


def _with_repeats(
    docs: DataFrame, told: DataFrame, again: DataFrame, dropped: DataFrame, doc_id: str, text: str
) -> DataFrame:
    """As ``one_of_each`` where ids repeat or are NULL: those rows are told apart by their content."""
    many = again.where(F.col(doc_id).isNotNull())
    others = stored(dropped.unionByName(many).distinct(), "others")
    single = join_small(docs.where(F.col(doc_id).isNotNull()), others, [doc_id], "left_anti")
    same = F.col(doc_id).eqNullSafe(F.col("_again"))
    repeated = docs.join(again.withColumnRenamed(doc_id, "_again"), same, "left_semi")
    known = told.select(F.col("set_key").alias("_set"), F.col("class_id").alias("_id"), "class_key")
    known = known.where(F.col("_set").isNotNull()).distinct()
    rows = stored(keyed(repeated, text).join(known, "_set", "left"), "repeated")
    wordless = rows.where(F.col("_set").isNull()).select(*docs.columns)
    first = rows.where(F.col("_set").isNotNull() & F.col(doc_id).eqNullSafe(F.col("_id")))
    row = F.struct(text, *[c for c in docs.columns if c != text])
    kept = first.groupBy("class_key").agg(F.min(row).alias("row")).select("row.*")
    return single.unionByName(wordless).unionByName(kept)
