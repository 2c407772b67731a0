from __future__ import annotations

import datetime
import random
import re

import pytest
from llm_cases import ODD, clashing, empty_documents, given, odd_documents

from shoplake.llm import pii as P

KEY = b"0123456789abcdef"


@pytest.fixture(scope="module")
def f():
    return P.Feistel(KEY)


def changed(f, text):
    return P.pseudonymise(f, text)[0]


@pytest.mark.parametrize("size", [1, 2, 26, 97, 260, 676, 1000])
@pytest.mark.parametrize("key", range(10))
def test_a_permutation_of_any_size(key, size):
    f = P.Feistel(f"the key of test {key:2d}".encode())
    assert sorted(f.permute("x", v, size) for v in range(size)) == list(range(size))


@pytest.mark.parametrize("key", range(3))
def test_a_permutation_of_all_days(key):
    f = P.Feistel(f"the key of test {key:2d}".encode())
    assert sorted(f.permute("date", v, 73049) for v in range(73049)) == list(range(73049))


def test_equal_values_stay_linked_in_every_format(f):
    plain = changed(f, "4041894974608795")
    assert changed(f, "4041 8949 7460 8795").replace(" ", "") == plain
    assert changed(f, "x 4041-8949-7460-8795.")[2:-1].replace("-", "") == plain
    assert P.luhn_digit(plain[:-1]) == plain[-1] and len(plain) == 16
    assert changed(f, "+1 (988) 555-2485")[3:] == changed(f, "(988) 555-2485")
    assert P.digits(changed(f, "988-555-2485")) == P.digits(changed(f, "988 555 2485"))
    iso = datetime.date.fromisoformat(changed(f, "2024-02-29"))
    assert changed(f, "29.02.2024") == iso.strftime("%d.%m.%Y")
    assert changed(f, "02/29/2024") == iso.strftime("%m/%d/%Y")
    assert changed(P.Feistel(b"another key, as long"), "2024-02-29") != iso.isoformat()


@pytest.mark.parametrize(
    "text",
    [
        "4041894974608796",  # wrong check digit
        "300.1.2.4",
        "1.2.3.4.5",
        "2024-02-30",
        "31/02/2024",
        "000-12-3456",
        "666-12-3456",
        "123-00-4567",
        "000 000 0000",
        "000-555-1234",
        "555-123-4567",
        "1111 1111 1111 1111",
        "version 1.2.3",
        "a@b",
        "0123456789abcdef4041894974608795",
        "",
    ],
)
def test_what_is_not_valid_stays(f, text):
    assert P.pseudonymise(f, text) == (text, dict.fromkeys(P.KINDS, 0))


def test_formats_are_kept(f):
    dice = random.Random(3)
    shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", s)))
    for _ in range(300):
        number = "".join(dice.choices("0123456789", k=dice.choice([12, 14, 15, 18])))
        card = number + P.luhn_digit(number)
        mail = "".join(dice.choices("abcXYZ019", k=6)) + "x@mail.example.com"
        ssn = f"{dice.randint(667, 899)}-{dice.randint(1, 99):02d}-{dice.randint(1, 9999):04d}"
        for value in (card, mail, ssn, "2031-12-31", "+44 (020) 794-6000"):
            new = changed(f, value)
            assert new != value and shape(new) == shape(value)
            assert changed(f, new) != new  # it is valid itself
        assert changed(f, mail).endswith("@mail.example.com")


def test_two_values_never_meet(f):
    ssn = [f"{a:03d}-{g:02d}-0001" for a in (1, 665, 667, 899) for g in (1, 50, 99)]
    ips = [f"10.0.{a}.{b}" for a in range(30) for b in range(30)]
    days = [str(datetime.date(1990, 1, 1) + datetime.timedelta(k)) for k in range(3000)]
    for values in (ssn, ips, days):
        assert len({changed(f, v) for v in values}) == len(values)
    names = [f"{a}{b}@mail.example.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    assert sorted(changed(f, v) for v in names) == names
    phones = [f"({a:03d}) {e:03d}-0000" for a in (1, 17, 555, 999) for e in (200, 555, 999)]
    assert len({changed(f, v) for v in phones}) == len(phones)


def test_given_documents(spark, f):
    rows = P.pseudonyms(given(spark, "documents", "/root/testdata/sf0.01"), KEY).collect()
    before = {r["doc_id"]: r["text"] for r in given(spark, "documents", "/root/testdata/sf0.01").collect()}
    assert len(rows) == len(before) and sum(r["n_replaced"] for r in rows) > 20
    for r in rows:
        old = before[r["doc_id"]]
        for m in re.finditer(r"[\w.]+@\w+\.example\.com|(?<![\w.])\d+\.\d+\.\d+\.\d+(?![\w])", old):
            assert m[0] not in r["text"]
        if not r["n_replaced"]:
            assert r["text"] == old
        assert r["n_replaced"] == sum(r[f"n_{k}"] for k in P.KINDS)


def test_odd_rows(spark):
    rows = P.pseudonyms(clashing(odd_documents(spark), "n_card", "N_Replaced"), KEY).collect()
    assert sorted(repr(r["text"]) for r in rows) == sorted(repr(r[1]) for r in ODD)
    assert P.pseudonyms(empty_documents(spark), KEY).collect() == []
    with pytest.raises(ValueError):
        P.pseudonyms(odd_documents(spark), b"short")


@pytest.mark.parametrize("card", ["4111 1111 1111 1111", "3782 822463 10005", "4111-1111-1111-1111", "3056 930902 5904"])
@pytest.mark.parametrize("tail", [" 123", " 7", " 12/28", " 12 28", " 01/02/2024", " 123 45", "-123", " 1.2.3.4"])
def test_a_card_before_another_number(f, card, tail):
    """It gets the pseudonym that it has alone."""
    alone = changed(f, card)
    assert alone != card
    text, counts = P.pseudonymise(f, card + tail)
    if len(P.digits(card)) == 14 and P.card_ends(card + tail, 0)[0] != len(card):
        # a longer run has a valid Luhn digit too, and neither length is common: the longer one is taken
        longer = (card + tail)[: P.card_ends(card + tail, 0)[0]]
        assert text == changed(f, longer) + (card + tail)[len(longer) :] and counts["card"] == 1
        return
    assert text.startswith(alone) and counts["card"] == 1
    if not re.search(r"[/.]", tail):
        assert text == alone + tail


@pytest.mark.parametrize("head", ["12 ", "7 ", "123 ", "12345 "])
def test_a_card_after_another_number(f, head):
    card = "4556 7375 8689 9855"
    assert changed(f, head + card) == head + changed(f, card)


def test_every_tail_of_three_digits(f):
    """Also where the longer run has a valid Luhn digit by chance."""
    alone = changed(f, "4111 1111 1111 1111")
    for k in range(1000):
        assert changed(f, f"4111 1111 1111 1111 {k:03d}") == f"{alone} {k:03d}"


def test_two_cards_in_a_row(f):
    one, two = "378282246310005", "4111 1111 1111 1111"
    assert changed(f, f"{one} {two}") == f"{changed(f, one)} {changed(f, two)}"
    assert changed(f, f"{two} {one}") == f"{changed(f, two)} {changed(f, one)}"


@pytest.mark.parametrize("card", ["378 282 246 310 005", "41 11 11 11 11 11 11 11", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"])
def test_a_card_in_short_groups_is_found_alone(f, card):
    text, counts = P.pseudonymise(f, f"card {card}")
    assert counts["card"] == 1 and card not in text
    assert P.pseudonymise(f, f"card {card} in the year 2024")[0] == f"{text} in the year 2024"


def plainly_found(text):
    """(kind, value) of what stands between blanks, told by hand, without patterns."""
    found = []
    for word in text.split():
        parts = word.split(".")
        if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", word))
        parts = word.split("-")
        if [len(p) for p in parts] == [3, 2, 4] and all(p.isdigit() for p in parts):
            if parts[0] not in ("000", "666") and parts[0] < "900" and parts[1] != "00" and parts[2] != "0000":
                found.append(("ssn", word))
        if [len(p) for p in parts] == [3, 3, 4] and all(p.isdigit() for p in parts):
            if parts[0] != "000" and parts[1] >= "200":
                found.append(("phone", word))
        if [len(p) for p in parts] == [4, 2, 2] and all(p.isdigit() for p in parts) and "1900" <= parts[0] <= "2099":
            try:
                datetime.date(*map(int, parts))
                found.append(("date", word))
            except ValueError:
                pass
        if word.isdigit() and 13 <= len(word) <= 19 and len(set(word)) > 1:
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(word))]
            if sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
                found.append(("card", word))
        name, _, host = word.partition("@")
        if name.isalnum() and host == "x.example.com":
            found.append(("email", word))
    return found


def test_the_finder_against_a_plain_one(f):
    dice = random.Random(9)
    number = lambda n: "".join(dice.choices("0123456789", k=n))
    for _ in range(400):
        words = []
        for _ in range(12):
            words += [
                dice.choice(
                    [
                        ".".join(str(dice.randint(0, 300)) for _ in range(4)),
                        f"{number(3)}-{number(2)}-{number(4)}",
                        f"{number(3)}-{number(3)}-{number(4)}",
                        f"{dice.randint(1890, 2110)}-{dice.randint(0, 13):02d}-{dice.randint(0, 32):02d}",
                        number(dice.randint(12, 20)),
                        f"a{number(3)}@x.example.com",
                        "word",
                    ]
                ),
                "and",
            ]
        text = " ".join(words)
        want = plainly_found(text)
        new, counts = P.pseudonymise(f, text)
        assert counts == {k: sum(kind == k for kind, _ in want) for k in P.KINDS}
        values = [value for _, value in want]
        pairs = list(zip(text.split(), new.split(), strict=True))
        assert [old for old, now in pairs if old in values] == values
        assert all(old == now for old, now in pairs if old not in values)
        assert all(now == changed(f, old) for old, now in pairs if old in values)
