"""Secret scans over an incremental blob ledger, with SQL functions only.

Every version of a text is a blob, named by the SHA-256 of its content; every rule has a version, which changes with
its pattern. The ledger has the pairs of blob and rule version that were scanned, and what was found. A scan
first compares hashes with the ledger, and scans each blob with the rules that it was not scanned with yet:
unchanged content is never scanned again, copies are scanned once, and a new rule is looked for in old blobs
alone, without the others. Findings are joined back to every path (row) that has the blob.

Places come without a UDF: a match and the gap before it are as long as the pieces that
``regexp_extract_all`` and ``split`` return, so running sums of their lengths are the offsets.

Copies collapse within the tasks before blobs are shuffled. Only blobs with findings are in the join
back; it is a broadcast where they are counted to be few, so that the documents stay where they are.

Defined results: NULL text is scanned as the empty text; an empty table gives no rows; repeated
rows share one blob and each get its findings. Columns of the documents are kept unless a result
has the same name.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.config import scratch_dir
from shoplake.llm.common import join_small, named, stored

#: Findings of up to so many blobs and spans, some 30 MB, are broadcast; more are joined by shuffle.
SMALL_BLOBS, SMALL_SPANS = 50_000, 200_000

#: Where the ledger of the query and of the pipeline is kept from one application to the next.
LEDGER_SETTING = "spark.shoplake.ledger"
SPAN = "array<struct<start:int,place:int,end:int,kind:string>>"
STORED_SPAN = "array<struct<start:int,end:int,rule:string>>"
#: Runs of a ledger that are put together to one.
MOST_RUNS = 64
BLOB = "blob"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a Java pattern, and the least length of the match or of one group."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# What the base rules are. Their order is the order of kinds at the same place.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Further public token formats.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


def rule_version(rule: Rule) -> str:
    """Changes whenever the rule does."""
    return hashlib.sha256(repr(rule).encode()).hexdigest()[:16]


def versions_of(rules: Sequence[Rule]) -> Column:
    return F.array(*[F.lit(rule_version(r)) for r in rules])


def let(value: Column, use: object) -> Column:
    """Evaluate ``value`` once and use it several times in an expression."""
    return F.transform(F.array(value), use)[0]  # type: ignore[arg-type]


def matches(text: Column, rule: Rule, place: int) -> Column:
    """Spans of the leftmost matches that do not overlap, short ones dropped; code points."""
    pattern = F.lit(rule.pattern)

    def spans(gaps: Column) -> Column:
        whole = F.regexp_extract_all(text, pattern, F.lit(0))
        measured = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole

        def placed(found: Column) -> Column:
            sized = F.transform(
                found["whole"],
                lambda m, i: F.struct(
                    F.length(gaps[i]).alias("gap"),
                    F.length(m).alias("size"),
                    F.length(found["measured"][i]).alias("measured"),
                ),
            )
            start = F.struct(
                F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")
            )

            def add(done: Column, m: Column) -> Column:
                begin = done["at"] + m["gap"]
                end = begin + m["size"]
                span = F.struct(
                    begin.alias("start"),
                    F.lit(place).alias("place"),
                    end.alias("end"),
                    F.lit(rule.kind).alias("kind"),
                )
                kept = F.when(m["measured"] >= rule.least, F.array(span)).otherwise(
                    F.array().cast(SPAN)
                )
                return F.struct(end.alias("at"), F.concat(done["spans"], kept).alias("spans"))

            return F.aggregate(sized, start, add, lambda done: done["spans"])

        return let(F.struct(whole.alias("whole"), measured.alias("measured")), placed)

    found = let(F.split(text, rule.pattern, -1), spans)
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(SPAN))


def scan(blobs: DataFrame, text: str, rules: Sequence[Rule], asked: Column | None = None) -> DataFrame:
    """Adds ``spans``, sorted by start and order of rules. ``asked`` has the versions of the rules to scan a row with."""
    none = F.array().cast(SPAN)

    def found(i: int, rule: Rule) -> Column:
        spans = matches(F.col(text), rule, i)
        return spans if asked is None else F.when(F.array_contains(asked, rule_version(rule)), spans).otherwise(none)

    every = F.concat(*[found(i, rule) for i, rule in enumerate(rules)])
    return blobs.withColumn("spans", F.sort_array(every))


class Ledger:
    """Runs in a folder that all executors share; each has the blobs it scanned, with which rules, and its findings.

    A run counts once its marker is there, which is written last. After ``MOST_RUNS`` runs they are put together
    to one, whose marker names those that it stands for.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark = spark
        self.path = path or scratch_dir(spark, "ledger")

    def runs(self) -> list[str]:
        """The folders that count."""
        to_path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = to_path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        marks = fs.globStatus(to_path(f"{self.path}/*/done")) or []
        whole = {m.getPath().getParent().toString(): m for m in marks}
        replaced = set()
        for mark in whole.values():
            if mark.getLen():
                file = fs.open(mark.getPath())
                replaced |= set(str(file.readUTF()).split())
                file.close()
        return sorted(r for r in whole if r.rsplit("/", 1)[-1] not in replaced)

    def _mark(self, run: str, stands_for: list[str]) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{run}/done")
        file = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path)
        if stands_for:
            file.writeUTF(" ".join(r.rsplit("/", 1)[-1] for r in stands_for))
        file.close()

    def _read(self, name: str, schema: str) -> DataFrame | None:
        runs = self.runs()
        return self.spark.read.schema(schema).parquet(*[f"{r}/{name}" for r in runs]) if runs else None

    def seen(self) -> DataFrame | None:
        """(blob, rules): the versions of the rules that each blob was scanned with. None before the first scan."""
        rows = self._read("scanned", "blob binary, rules array<string>")
        return rows and rows.groupBy(BLOB).agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))

    def findings(self, rules: Sequence[Rule]) -> DataFrame | None:
        """(blob, spans) of what these rules have found, sorted."""
        rows = self._read("findings", f"blob binary, spans {STORED_SPAN}")
        if rows is None:
            return None
        kinds = F.create_map(
            *[x for i, r in enumerate(rules) for x in (F.lit(rule_version(r)), F.struct(F.lit(i), F.lit(r.kind)))]
        )
        asked = F.filter("spans", lambda x: F.array_contains(versions_of(rules), x["rule"]))
        told = F.transform(
            asked, lambda x: F.struct(x["start"], kinds[x["rule"]]["col1"], x["end"], kinds[x["rule"]]["col2"])
        )
        rows = rows.select(BLOB, told.cast(SPAN).alias("spans")).where(F.size("spans") > 0)
        return rows.groupBy(BLOB).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))

    def add(self, fresh: DataFrame, rules: Sequence[Rule], text: str) -> None:
        """Scan blobs with the rules they are ``asked`` for; a run counts once all of it is written."""
        run = f"{self.path}/run-{uuid.uuid4().hex}"
        kept = f"blob binary, asked array<string>, spans {SPAN}"
        told = scan(fresh, text, rules, F.col("asked")).select(BLOB, "asked", "spans")
        told.write.option("compression", "zstd").parquet(f"{run}/all")
        found = self.spark.read.schema(kept).parquet(f"{run}/all")
        rule = F.transform(
            "spans", lambda x: F.struct(x["start"], x["end"], F.element_at(versions_of(rules), x["place"] + 1))
        )
        found.where(F.size("spans") > 0).select(BLOB, rule.cast(STORED_SPAN).alias("spans")).write.parquet(
            f"{run}/findings"
        )
        found.select(BLOB, F.col("asked").alias("rules")).write.parquet(f"{run}/scanned")
        self._mark(run, [])
        if len(self.runs()) >= MOST_RUNS:
            self.put_together()

    def put_together(self) -> None:
        """All runs as one. The old ones stay for readers that have begun, but count no longer."""
        old, run = self.runs(), f"{self.path}/base-{uuid.uuid4().hex}"
        self.seen().write.parquet(f"{run}/scanned")
        rows = self._read("findings", f"blob binary, spans {STORED_SPAN}")
        rows.groupBy(BLOB).agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")).write.parquet(
            f"{run}/findings"
        )
        self._mark(run, old)


def content(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(content(text).cast("binary"), 256))


def scan_new(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
    """Scan what the ledger lacks and enter it.

    The distinct of (blob, text) is done within the tasks first. What is missing is found by hashes, before
    any text is shuffled.
    """
    blobs = docs.select(blob_of(text).alias(BLOB), content(text).alias("content"))
    every, seen = versions_of(rules), ledger.seen()
    if seen is None:
        ledger.add(blobs.distinct().withColumn("asked", every), rules, "content")
        return
    told = blobs.select(BLOB).distinct().join(seen, BLOB, "left")
    missing = F.coalesce(F.array_except(every, F.col("rules")), every)
    missing = stored(told.select(BLOB, missing.alias("asked")).where(F.size("asked") > 0), "missing")
    if missing.isEmpty():
        return
    fresh = join_small(blobs, missing.select(BLOB), [BLOB], "left_semi").distinct()
    ledger.add(fresh.join(missing, BLOB), rules, "content")


def scan_documents(
    docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, text: str = "text"
) -> DataFrame:
    """Adds ``blob`` and ``spans`` to every document, after scanning what is new."""
    scan_new(docs, ledger, rules, text)
    found = stored(ledger.findings(rules), "findings")
    kept = [named(c) for c in docs.columns if c.lower() not in (BLOB, "spans")]
    blobs = docs.select(*kept, blob_of(text).alias(BLOB))
    size = found.agg(F.count("*").alias("blobs"), F.sum(F.size("spans")).alias("spans")).first()
    small = size["blobs"] <= SMALL_BLOBS and (size["spans"] or 0) <= SMALL_SPANS
    joined = blobs.join(F.broadcast(found) if small else found, BLOB, "left")
    return joined.select(
        *kept,
        BLOB,
        F.coalesce("spans", F.array().cast(SPAN)).alias("spans"),
    )


def count_of(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def base_only(spans: str = "spans", rules: Sequence[Rule] = BASE_RULES) -> Column:
    kinds = [r.kind for r in rules]
    return F.filter(spans, lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))


def redacted(text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by a mark; else byte for byte."""
    source = F.col(text)

    def add(done: Column, s: Column) -> Column:
        gap = F.substring(source, done["at"] + 1, s["start"] - done["at"])
        new = F.concat(done["out"], gap, F.lit(mark))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] < done["at"], done["out"]).otherwise(new).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        F.col(spans),
        start,
        add,
        lambda done: F.concat(done["out"], F.substring(source, done["at"] + 1, F.length(source))),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(source)
