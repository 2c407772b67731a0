"""From raw documents to token ids, in five stages; each is written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import bpe, decontaminate, jaccard, language, secret_scan
from shoplake.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def as_documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with a length that follows the text."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without any letter go; a missing language is filled in."""
    prototypes = language.learn_prototypes(docs.where(~language.held_out_rows("doc_id")))
    told = language.predict(docs, prototypes)
    told = told.where(F.col("lang_pred") != language.UNKNOWN) if prototypes else language.lettered(told)
    return as_documents(told.withColumn("lang", F.coalesce("lang", "lang_pred")))


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    return jaccard.one_of_each(docs).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter passages of items are cut out of the others."""
    return as_documents(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    ledger = secret_scan.Ledger(spark, spark.conf.get(secret_scan.LEDGER_SETTING, None))
    found = secret_scan.scan_documents(docs, ledger)
    return as_documents(found.withColumn("text", secret_scan.redacted()))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them again."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select(
        "doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", same.alias("round_trip")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_text),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", as_tokens),
]

#: Learned prototypes, MinHash bands and merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
