"""The registered queries and the pipeline."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_cases import DATA, ODD, SCHEMA, given
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from shoplake.llm import language, secret_scan
from shoplake.llm.oracle import LLM_ORACLE
from shoplake.llm.queries import LLM_QUERIES

TABLES = ("documents", "benchmark", "labels", "conversations")
DOCUMENT_QUERIES = [n for n in LLM_QUERIES if n not in ("op8_chat", "op12_phrases")]


def test_all_are_registered():
    found = entry_points.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in found if n in LLM_QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in found
    assert set(LLM_ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_one_row_for_each_document(spark, name):
    rows = LLM_QUERIES[name](spark, DATA).select("doc_id").collect()
    assert sorted(r[0] for r in rows) == sorted(
        r[0] for r in given(spark, "documents").select("doc_id").collect()
    )


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    got = LLM_QUERIES[name](spark, DATA)
    want = con.execute(LLM_ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    mine = sorted((tuple(r[n] for n in order) for r in got.collect()), key=repr)
    theirs = [dict(zip(names, r, strict=True)) for r in want.fetchall()]
    assert mine == sorted((tuple(r[n] for n in order) for r in theirs), key=repr)


def test_digests(spark):
    texts = {r["doc_id"]: r["text"] for r in given(spark, "documents").collect()}
    for r in LLM_QUERIES["op1_bpe"](spark, DATA).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    for r in LLM_QUERIES["op9_sharding"](spark, DATA).collect():
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    for r in LLM_QUERIES["op6_secrets"](spark, DATA).collect():
        spans = [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()


def odd_folder(spark, tmp_path, rows):
    """The given tables with other documents, which also have columns called like results."""
    names = ("score", "shard", "blob", "spans", "n_words", "set_key", "class_id", "lang_pred", "n_tokens")
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'clash' AS {n}" for n in names])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in TABLES[1:]:
        given(spark, t).write.parquet(f"{tmp_path}/{t}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_odd_tables(spark, tmp_path, rows):
    folder = odd_folder(spark, tmp_path, rows)
    for name in DOCUMENT_QUERIES:
        assert LLM_QUERIES[name](spark, folder).count() == len(rows), name
    assert corpus_pipeline.run(spark, folder).count() <= len(rows)


def test_pipeline_by_stage(spark):
    """Each stage keeps what it should of its own input."""
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    docs = given(spark, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == docs.columns, name
    marked = docs.unionByName(spark.createDataFrame([(-1, "12 !", None, None, 4), (-2, None, None, None, None)], SCHEMA))
    kept = {r["doc_id"]: r for r in stages["language ID"](spark, marked, DATA).collect()}
    assert set(kept) == {r["doc_id"] for r in docs.collect()}
    secret = spark.createDataFrame([(-3, "a token=abcdefghijklmnop b", "en", "s", 26)], SCHEMA)
    told = stages["secret scans"](spark, secret, DATA).first()
    assert (told["text"], told["n_chars"]) == ("a [SECRET] b", 12)
    item = given(spark, "benchmark").first()["text"]
    planted = spark.createDataFrame([(-4, item, "en", "s", 1), (-5, "nothing of the kind", "en", "s", 1)], SCHEMA)
    found = stages["benchmark decontamination"](spark, planted, DATA).collect()
    assert [r["doc_id"] for r in found] == [-5]


def test_pipeline(spark):
    made = corpus_pipeline.run(spark, DATA).collect()
    assert made and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in made)
    ids = [r["doc_id"] for r in made]
    assert len(ids) == len(set(ids)) < given(spark, "documents").count()


def test_texts_without_letters_go_without_prototypes_too(spark):
    rows = [(1, None, None, None, None), (2, "", None, None, 0), (3, "12 !", None, "s", 4), (4, "été 1", None, "s", 5)]
    docs = spark.createDataFrame([*rows, (None, "日本", None, "s", 2)], SCHEMA)
    kept = corpus_pipeline.known_language(spark, docs, DATA).collect()
    assert sorted(r["text"] for r in kept) == ["été 1", "日本"]


def plain_bundle(text, space, known):
    """The sum of a text's n-gram vectors, one n-gram after the other."""
    line = "__" + "".join(c if c.isalpha() else "_" for c in (text or "").lower()) + "__"
    counts = Counter(line[i - 1 : i + 2] for i in range(1, len(line) - 1) if line[i] != "_")
    total = np.zeros(space.dims)
    for gram, n in counts.items():
        if gram not in known:
            letters = [space.letter(0 if c == "_" else ord(c)) for c in gram]
            known[gram] = np.prod([np.roll(v, k) for k, v in enumerate(letters)], axis=0)
        total += n * known[gram]
    return total


def test_language_stage_against_plain_sums(spark):
    """Of the given documents and odd ones, with every seventh language unknown."""
    docs = given(spark, "documents").selectExpr(
        "doc_id", "text", "CASE WHEN doc_id % 7 > 0 THEN lang END AS lang", "source", "n_chars"
    )
    docs = docs.unionByName(spark.createDataFrame([r for r in ODD if r[0] is None], SCHEMA))
    docs = docs.unionByName(spark.createDataFrame([(-1, "1 2 !", None, None, 5), (-2, "", "en", "s", 0)], SCHEMA))
    rows, space, known = docs.collect(), language.Space(), {}
    bundles = [plain_bundle(r["text"], space, known) for r in rows]
    sums = {}
    for r, bundle in zip(rows, bundles, strict=True):
        crc = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode())
        if crc % 5 and r["lang"] is not None and bundle.any():
            sums[r["lang"]] = sums.get(r["lang"], 0) + bundle
    names = sorted(sums)
    unit = np.stack([sums[k] / np.linalg.norm(sums[k]) for k in names])
    away = unit - unit.mean(axis=0)
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    want = Counter()
    for r, bundle in zip(rows, bundles, strict=True):
        if any(c.isalpha() for c in r["text"] or ""):
            rest = bundle / np.linalg.norm(bundle) - unit.mean(axis=0)
            told = names[int(np.argmax(away @ rest))]
            want[(r["doc_id"], r["text"], r["lang"] or told, r["source"], len(r["text"]))] += 1
    kept = corpus_pipeline.known_language(spark, docs, DATA).collect()
    assert Counter(tuple(r) for r in kept) == want


def plain_redaction(text):
    """Every run of overlapping matches of Python's patterns becomes one mark."""
    spans = []
    for rule in secret_scan.RULES:
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                spans.append(m.span())
    out, at = "", 0
    for start, end in sorted(spans):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_secrets_stage_against_plain_patterns(spark):
    docs = given(spark, "documents").unionByName(spark.createDataFrame(ODD, SCHEMA))
    docs = docs.unionByName(
        spark.createDataFrame(
            [(-1, "token=" + "0123456789abcdef" * 2 + " AKIA" + "A1" * 8 + " 😀 api_key: deadbeefdeadbeef", "en", "s", 1)], SCHEMA
        )
    )
    want = Counter()
    for r in docs.collect():
        text = None if r["text"] is None else plain_redaction(r["text"])
        want[(r["doc_id"], text, r["lang"], r["source"], None if text is None else len(text))] += 1
    kept = corpus_pipeline.without_secrets(spark, docs, DATA).collect()
    assert Counter(tuple(r) for r in kept) == want
    assert sum("[SECRET]" in (r["text"] or "") for r in kept) > 1


def test_token_stage_against_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = given(spark, "documents").unionByName(spark.createDataFrame(ODD, SCHEMA))
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[(r["doc_id"], r["lang"], r["source"], r["n_chars"], len(ids), tuple(ids), True)] += 1
    made = corpus_pipeline.as_tokens(spark, docs, DATA).collect()
    assert Counter((*r[:5], tuple(r["token_ids"]), r["round_trip"]) for r in made) == want
