"""One query per operator, over the whole given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import (
    bpe,
    chat,
    decontaminate,
    jaccard,
    language,
    lm_score,
    mixing,
    phrases,
    pii,
    quality,
    runs,
    secret_scan,
    sharding,
)
from shoplake.llm.common import doc_crc, stored, table

#: Shards of the sharding query, all of the same weight.
SHARDS = 24
#: Where the key of the pseudonyms is taken from. Without it each application draws one that nobody keeps, so its
#: pseudonyms are linked with one another only.
PII_KEY_SETTING = "spark.shoplake.pii.key"
DRAWN_KEYS: dict[str, str] = {}


def ledger_of(spark: SparkSession) -> secret_scan.Ledger:
    """The ledger in the folder of the setting; without it, one that ends with the application."""
    return secret_scan.Ledger(spark, spark.conf.get(secret_scan.LEDGER_SETTING, None))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode_decode(docs, path, keep_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = decontaminate.match_items(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(matched).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_text_links", "n_grams")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out_rows("doc_id")
    prototypes = language.learn_prototypes(docs.where(~held_out))
    asked = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language.predict(asked, prototypes).select("doc_id", "held_out", "lang_pred", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = stored(quality.with_counts(docs).drop("text"), "quality")
    rules = quality.learn_rules(counted, table(spark, sf_dir, "labels"))
    return quality.judged(counted, rules).select(
        "doc_id", *quality.COUNTS[:5], "base_failed", "kept", "dropped_by"
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_documents(docs, ledger_of(spark))
    base = secret_scan.written(secret_scan.base_only())
    return found.select(
        "doc_id",
        *[secret_scan.count_of(r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE_RULES],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
        F.lower(F.hex("blob")).alias("blob"),
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.score(table(spark, sf_dir, "documents"), doc_crc() % 7 != 2)
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chat.rotate(table(spark, sf_dir, "conversations"))
    masks = F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return made.withColumn("masks", F.array_join(masks, ","))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.assign(docs, [1.0] * SHARDS).drop("text")
    numbered = sharding.number(placed, by=("doc_id", "text_crc32", "size"))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = spark.conf.get(PII_KEY_SETTING, None)
    if not key:
        key = DRAWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))
    return pii.pseudonyms(docs, key.encode())


def planted_period(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten repeat a period from some word on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(docs, edit=planted_period).drop("text")
    # most periods first, compared as fractions
    best = F.array_sort(
        "runs",
        lambda a, b: F.when(a["length"] * b["period"] > b["length"] * a["period"], -1)
        .when(a["length"] * b["period"] < b["length"] * a["period"], 1)
        .otherwise(F.when((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"])), -1)
        .otherwise(1)),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.try_element_at(best, F.lit(1))).select(
        "doc_id",
        "n_runs",
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.best_of_each(phrases.collocations(docs))


#: Weights of the sources, in turn: 5 early, 2 throughout and 1 late.
SCHEDULES = (((0, 7.5), (1, 2.5)), ((0, 2.0), (1, 2.0)), ((0, 0.5), (1, 1.5)))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.words_in("text").alias("size"), F.monotonically_increasing_id().alias("row")
    )
    takes = mixing.in_order(mixing.mix(docs, SCHEDULES))
    return (
        takes.groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(
            F.sum("words").cast("long").alias("taken"),
            F.count("number").alias("n_takes"),
            F.min(F.when(F.col("words") > 0, F.col("at"))).alias("first_at"),
        )
        .drop("row")
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_decontaminate,
        op3_jaccard,
        op4_language,
        op5_quality,
        op6_secrets,
        op7_lm_score,
        op8_chat,
        op9_sharding,
        op10_pii,
        op11_periodic_runs,
        op12_phrases,
        op13_mixing,
    )
}
