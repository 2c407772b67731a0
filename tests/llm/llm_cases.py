"""Documents that every operator has to cope with, and plain Python versions of what they compute."""

from __future__ import annotations

from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"
SCHEMA = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": n, "type": t, "nullable": True, "metadata": {}}
            for n, t in (
                ("doc_id", "long"),
                ("text", "string"),
                ("lang", "string"),
                ("source", "string"),
                ("n_chars", "long"),
            )
        ],
    }
)

LONG = " ".join(f"word{i % 977} the" for i in range(30_000))
PROSE = "the cat sat on the mat and then it went out of the house into the garden to look at birds"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", None, 0),
    (3, " \n\t ", "en", "s", 4),
    (4, "...!!", None, "s", 5),
    (5, PROSE, "en", "s", None),
    (6, PROSE, "en", "t", None),
    (7, PROSE + " again", "en", "s", None),
    (7, PROSE + " again", "en", "s", None),
    (8, LONG, "en", "s", None),
    (9, "😀 naïve Straße ￿ <|endoftext|> 日本語 'll \u0000 x", None, None, None),
    (None, "a row without an id", None, None, None),
    (None, "a row without an id", None, None, None),
    (None, None, None, None, None),
]


def odd_documents(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """With columns called like results."""
    for name in names:
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def given(spark, name, folder=DATA):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
