from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ODD, clashing, empty_documents, given, odd_documents
from tokenizers import Tokenizer

from shoplake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_tokenizer(PATH))


def unpacked(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_and_text_are_the_library_s(spark, library, codec):
    texts = [r["text"] or "" for r in given(spark, "documents").collect()] + [r[1] or "" for r in ODD]
    packed = codec.encode(texts)
    for text, mine in zip(texts, packed, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert unpacked(mine) == ids
        assert codec.decode(mine) == library.decode(ids, skip_special_tokens=False) == text
    assert codec.merged_words > 100  # proposals do fail


def test_random_strings(library, codec):
    dice = random.Random(4)
    parts = "a th e é ß 日本 😀 's ' 1 23 ! aaaa ---- <|endoftext|> ࢏ İ ﷺ".split()
    parts += [" ", "  ", "\n", "\t", "\x85", "\x1c", "　"]
    texts = ["".join(dice.choices(parts, k=dice.randint(0, 40))) for _ in range(4000)]
    for text, mine in zip(texts, codec.encode(texts), strict=True):
        assert unpacked(mine) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 3000, "-" * 3000 + "=" * 500])
def test_long_words(library, codec, text):
    assert unpacked(codec.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_merging_together_is_merging_one_by_one(codec):
    dice = random.Random(9)
    words = [bytes(dice.choices(b"aabehst -\xc3\xa9", k=dice.randint(1, 40))) for _ in range(3000)]
    together = codec.merged_together(words)
    assert [unpacked(t) for t in together] == [codec.merged(w) for w in words]


def test_compatible_pairs_are_those_that_stay_apart(codec):
    dice = random.Random(2)
    ids = [i for t, i in codec.ids.items() if len(t) < 8]
    a, b = (np.array(dice.choices(ids, k=4000)) for _ in range(2))
    whole = [codec.token_bytes[x] + codec.token_bytes[y] for x, y in zip(a, b, strict=True)]
    apart = [codec.merged(w) == [x, y] for w, x, y in zip(whole, a, b, strict=True)]
    assert codec.compatible(a, b).tolist() == apart
    assert 0 < sum(apart) < len(apart)


def test_a_full_cache_changes_nothing(spark, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 50 * 200)
    small = bpe.Codec(bpe.read_tokenizer(PATH))
    for row in given(spark, "documents").limit(20).collect():
        assert unpacked(small.encode([row["text"]])[0]) == library.encode(row["text"]).ids


def test_odd_rows(spark):
    docs = clashing(odd_documents(spark), "n_tokens", "Decoded")
    found = bpe.encode_decode(docs, PATH).collect()
    assert len(found) == len(ODD)
    assert sorted(r["decoded"] for r in found) == sorted(r[1] or "" for r in ODD)
    for r in found:
        assert r["n_tokens"] == len(r["token_ids"])
        packed = np.array(r["token_ids"], "<u4").tobytes()
        assert r["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.encode_decode(empty_documents(spark), PATH).collect() == []


def test_the_cache_is_bounded_in_bytes(monkeypatch):
    """Texts without blanks are words of any length; results do not depend on what is kept."""
    content = bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x" + f"{k:04d}" * 500 for k in range(60)]
    free = bpe.Codec(content).encode(texts)
    monkeypatch.setattr(bpe, "CACHED_BYTES", 50_000)
    codec = bpe.Codec(content)
    assert [codec.encode([t])[0] for t in texts] == free
    assert sum(len(w) for w in codec.known.keys() - codec.fixed.keys()) * bpe.LETTER_BYTES <= 50_000
