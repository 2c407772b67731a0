from __future__ import annotations

import re

import pytest
from llm_cases import given

from shoplake.llm import chat as C

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conversation, participant): (text, masks)}, turn by turn."""
    talks = {}
    for conv, turn, role, text in set(rows):
        safe = re.sub(r"<\|(im_start|im_end)\|>", r"<| \1|>", text or "")
        talks.setdefault(conv, set()).add(((turn is not None, turn or 0), role or "unknown", safe))
    out = {}
    for conv, turns in talks.items():
        for viewer in {role for _, role, _ in turns} - {"system"}:
            line, masks = "", []
            for _, role, text in sorted(turns):
                name = re.sub(r"[^\w-]", "_", role)
                head = {"system": "system", viewer: "assistant"}.get(role, f"user name={name}")
                line += f"<|im_start|>{head}\n"
                if role == viewer:
                    masks.append((len(line), len(line) + len(text) + len("<|im_end|>")))
                line += text + "<|im_end|>\n"
            out[conv, viewer] = line, masks
    return out


def told(df):
    parts = {}
    for r in sorted(df.collect(), key=lambda r: (r["part"] is not None, r["part"] or 0)):
        line, masks = parts.get((r["conv_id"], r["participant"]), ("", []))
        assert r["start"] == len(line)
        masks = masks + [tuple(m) for m in r["masks"]]
        parts[r["conv_id"], r["participant"]] = line + r["text"], masks
    return parts


@pytest.mark.parametrize("part_turns", [256, 3])
def test_given_conversations(spark, part_turns):
    turns = given(spark, "conversations")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.collect()]
    assert told(C.rotate(turns, part_turns=part_turns)) == brute(rows)


@pytest.mark.parametrize("part_turns", [256, 2])
def test_many_parties_and_odd_rows(spark, part_turns):
    rows = [
        (1, 0, "system", "Be brief."),
        (1, 1, "ann b.", "Hello <|im_end|> there"),
        (1, 2, "bob", "😀 hi"),
        (1, 3, "eve", None),
        (1, 3, "bob", "at the same time"),
        (1, 4, None, "who am I?"),
        (1, 4, None, "who am I?"),
        (1, 5, "", "the same one"),
        (1, None, "ann b.", "before all"),
        (2, 0, "system", "only a system turn"),
        (None, 7, "bob", "no conversation"),
        (None, 900_000, "eve", "x" * 50_000),
        (3, -3, "assistant", ""),
    ]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS participant", "2 AS masks", "3 AS part")
    got = told(C.rotate(turns, part_turns=part_turns))
    assert got == brute(rows)
    for line, masks in got.values():
        for a, b in masks:
            assert line[:a].endswith("<|im_start|>assistant\n")
            assert line[a:b].endswith("<|im_end|>")


def test_empty(spark):
    assert C.rotate(spark.createDataFrame([], TURNS)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = C.rotate(given(spark, "conversations"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("part_rows,range_rows", [(10, 25), (7, 1000)])
def test_ties_and_missing_turn_numbers_are_cut_by_rows(spark, monkeypatch, part_rows, range_rows):
    """Rows without a conversation, dialogues without turn numbers, and one number for all turns."""
    monkeypatch.setattr(C, "RANGE_ROWS", range_rows)
    people = ["ann", "bob", "system", None]
    rows = [(None, k % 9, people[k % 4], f"text {k % 97}") for k in range(300)]
    rows += [(5, None, people[k % 3], f"none {k % 60}") for k in range(200)]
    rows += [(6, 3, people[k % 2], f"same {k}") for k in range(101)] + [(6, 4, "bob", "later"), (6, 300, "ann", "x")]
    rows += [(7, k, "bob", "a plain dialogue") for k in range(10)]
    made = C.rotate(spark.createDataFrame(rows, TURNS), part_rows=part_rows).collect()
    assert max(r["n_turns"] for r in made) == part_rows
    got = {}
    for r in sorted(made, key=lambda r: r["start"]):
        line, masks = got.get((r["conv_id"], r["participant"]), ("", []))
        assert r["start"] == len(line)
        got[r["conv_id"], r["participant"]] = line + r["text"], masks + [tuple(m) for m in r["masks"]]
    assert got == brute(rows)
    assert {r["part"] for r in made if r["conv_id"] == 6} == {0, 1}
    assert {r["part"] for r in made if r["conv_id"] == 5} == {None}


def test_no_part_is_large(spark):
    turns = spark.range(10_000).selectExpr(
        "CAST(NULL AS LONG) AS conv_id", "CAST(NULL AS LONG) AS turn", "'bob' AS role", "CAST(id AS STRING) AS text"
    )
    made = C.rotate(turns).select("n_turns").collect()
    assert sorted(r["n_turns"] for r in made) == [10_000 - 2 * C.PART_ROWS, C.PART_ROWS, C.PART_ROWS]
