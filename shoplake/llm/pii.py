"""Format-preserving pseudonyms for personal data, from a keyed Feistel network.

Card numbers, phone numbers, IPv4 addresses, social security numbers, dates and the names in mail
addresses are found by pattern and validated (Luhn digit, octets, number ranges, calendar). A valid
value is taken apart into digits of mixed base, permuted under a secret key, and
put back in its own format. Equal values get equal pseudonyms in all documents, in whichever
format they are written; different values get different ones. Everything is a function of the
row and the key: nothing is joined or shuffled.

A Feistel network over two numbers (a modulo A, b modulo B) adds a keyed hash of one to the other,
in turn; each step can be undone, so the whole is a permutation of the A x B values. Domains that are
no product are walked until a value falls inside, which is a permutation too. So no two values of a domain ever
meet. One value of a domain may be its own pseudonym, on average, as in any random permutation:
moving it would give it another value's pseudonym.

Defined results: NULL text stays NULL; empty text stays empty; text without valid personal data
is returned byte for byte; repeated rows get equal results. Columns are kept unless a result
has the same name.
"""

from __future__ import annotations

import calendar
import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import cached, slices, small_batches

ROUNDS = 10

# First and last day that a date of birth or of an event may have.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)

KINDS = ("email", "card", "ssn", "ip", "date", "phone")

FINDER = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w@]))
  | (?P<ip>(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d))
  | (?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\w|[/.-]\d))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w|[.-]\d))
  | (?P<card>(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w|[.-]\d))
    """,
    re.VERBOSE | re.ASCII,
)
#: As many groups as a card may have, the ends of groups, and the usual numbers of digits.
CARD_RUN = re.compile(r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z_]|\.[0-9])")
GROUP_END = re.compile(r"(?<=[0-9])(?![0-9])")
COMMON_CARDS = (16, 15)
#: No value is found in a text without any of these.
HINT = re.compile(r"[0-9]{4}|@|[0-9][ ./-][0-9]|\)[ .-]?[0-9]")


class Feistel:
    """Keyed permutations of whole numbers."""

    def __init__(self, key: bytes) -> None:
        if len(key) < 16:
            raise ValueError("the key needs at least 16 bytes")
        self.key = key[:64]

    def hash(self, tag: str, turn: int, value: int) -> int:
        told = f"{tag}:{turn}:{value}".encode()
        return int.from_bytes(hashlib.blake2b(told, key=self.key, digest_size=32).digest(), "big")

    def pair(self, tag: str, value: int, a: int, b: int) -> int:
        """A permutation of range(a * b)."""
        x, y = divmod(value, b)
        for turn in range(ROUNDS):
            if turn % 2:
                y = (y + self.hash(tag, turn, x)) % b
            else:
                x = (x + self.hash(tag, turn, y)) % a
        return x * b + y

    def permute(self, tag: str, value: int, size: int) -> int:
        """A permutation of range(size): as with any other, a value may stay in place."""
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            value = self.pair(f"{tag}/{size}", value, a, b)
            if value < size:
                return value


def digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def fill(shape: str, new: str) -> str:
    """``shape`` with its digits replaced, in order."""
    left = iter(new)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def is_card(text: str) -> bool:
    number = digits(text)
    return 13 <= len(number) <= 19 and luhn_digit(number[:-1]) == number[-1] and len(set(number)) > 1


def card_ends(text: str, start: int) -> list[int]:
    """Where a valid number from ``start`` on may end: after any of its groups, common lengths first."""
    run = CARD_RUN.match(text, start)
    ends = [m.start() for m in GROUP_END.finditer(text, start, run.end())] if run else []
    found = [e for e in ends if is_card(text[start:e])]
    return sorted(found, key=lambda e: (len(digits(text[start:e])) not in COMMON_CARDS, -e))


def card_end(text: str, start: int, longest: int) -> int | None:
    """Where the card at ``start`` ends; another number may follow it, up to ``longest``.

    What only a shorter, uncommon length makes valid is left to a card of common length that begins inside.
    """
    ends = [e for e in card_ends(text, start) if e <= longest]
    if not ends:
        return None
    end = ends[0]
    if end < longest and len(digits(text[start:end])) not in COMMON_CARDS:
        for inner in re.finditer(" ", text[start:end]):
            begin = start + inner.end()
            if any(len(digits(text[begin:e])) in COMMON_CARDS for e in card_ends(text, begin)):
                return None
    return end


def new_card(f: Feistel, text: str) -> str | None:
    if not is_card(text):
        return None
    body = digits(text)[:-1]
    moved = str(f.permute("card", int(body), 10 ** len(body))).zfill(len(body))
    return fill(text, moved + luhn_digit(moved))


def new_ip(f: Feistel, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255:
        return None
    moved = f.permute("ip", int.from_bytes(bytes(octets), "big"), 1 << 32)
    return ".".join(map(str, moved.to_bytes(4, "big")))


def ssn_parts(number: str) -> tuple[int, int, int] | None:
    """Places of the three fields among their valid values."""
    area, group, serial = int(number[:3]), int(number[3:5]), int(number[5:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    return area - 1 - (area > 666), group - 1, serial - 1


def new_ssn(f: Feistel, text: str) -> str | None:
    parts = ssn_parts(digits(text))
    if parts is None:
        return None
    place = (parts[0] * 99 + parts[1]) * 9999 + parts[2]
    rest, serial = divmod(f.permute("ssn", place, 898 * 99 * 9999), 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


# How many area numbers there are, from 001, and exchange numbers, from 200.
AREAS, FIRST_EXCHANGE, EXCHANGES, LINES = 999, 200, 800, 10_000


def new_phone(f: Feistel, text: str) -> str | None:
    """The last ten digits are permuted among those with a valid area and exchange number; a country code stays."""
    number = digits(text)
    area, exchange, line = int(number[-10:-7]), int(number[-7:-4]), int(number[-4:])
    if area == 0 or exchange < FIRST_EXCHANGE:
        return None
    place = ((area - 1) * EXCHANGES + exchange - FIRST_EXCHANGE) * LINES + line
    rest, line = divmod(f.permute("phone", place, AREAS * EXCHANGES * LINES), LINES)
    area, exchange = divmod(rest, EXCHANGES)
    return fill(text, f"{number[:-10]}{area + 1:03d}{exchange + FIRST_EXCHANGE:03d}{line:04d}")


def new_date(f: Feistel, text: str) -> str | None:
    sep = next(c for c in text if not c.isdigit())
    fields = text.split(sep)
    if sep == "-":
        order = (0, 1, 2)
    else:  # day first with dots; with strokes month first unless that is no month
        order = (2, 0, 1) if sep == "/" and int(fields[0]) <= 12 else (2, 1, 0)
    year, month, day = (int(fields[k]) for k in order)
    if not 1 <= month <= 12 or not FIRST_DAY.year <= year <= LAST_DAY.year:
        return None
    if not 1 <= day <= calendar.monthrange(year, month)[1]:
        return None
    since = (datetime.date(year, month, day) - FIRST_DAY).days
    moved = FIRST_DAY + datetime.timedelta(
        f.permute("date", since, (LAST_DAY - FIRST_DAY).days + 1)
    )
    out = ["", "", ""]
    for k, value in zip(order, (moved.year, moved.month, moved.day), strict=True):
        out[k] = str(value).zfill(len(fields[k]))
    return sep.join(out)


def new_email(f: Feistel, text: str) -> str | None:
    """Letters and digits before the @ are permuted, each within its class."""
    name, _, host = text.partition("@")
    value, size = 0, 1
    bases = []
    for c in name:
        first, base = (ord("0"), 10) if c.isdigit() else (ord("a"), 26) if c.isalpha() else (0, 1)
        bases.append((first, base))
        value = value * base + (ord(c.lower()) - first if base > 1 else 0)
        size *= base
    value = f.permute("email", value, size)
    out = []
    for c, (first, base) in zip(reversed(name), reversed(bases), strict=True):
        value, d = divmod(value, base)
        new = chr(first + d) if base > 1 else c
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out)) + "@" + host


MAKERS: dict[str, Callable[[Feistel, str], str | None]] = {
    "email": new_email,
    "card": new_card,
    "ssn": new_ssn,
    "ip": new_ip,
    "date": new_date,
    "phone": new_phone,
}


def pseudonymise(f: Feistel, text: str | None) -> tuple[str | None, dict[str, int]]:
    """The text with valid values replaced, and how many of each kind."""
    counts = dict.fromkeys(KINDS, 0)
    if not text or not HINT.search(text):
        return text, counts
    known = cached(("pii", f.key), dict)
    if len(known) > 50_000:
        known.clear()
    out, at, look = [], 0, 0
    while m := FINDER.search(text, look):
        kind, end = m.lastgroup or "", m.end()
        if kind == "card":
            end = card_end(text, m.start(), end) or 0
        if not end:
            look = m.start() + 1
            continue
        value = text[m.start() : end]
        if (kind, value) not in known:
            known[kind, value] = MAKERS[kind](f, value)
        new = known[kind, value]
        if new is None:  # not valid: another kind may begin inside it
            look = m.start() + 1
            continue
        counts[kind] += 1
        out += [text[at : m.start()], new]
        at = look = end
    return "".join(out) + text[at:], counts


def pseudonyms(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """Replaces the text and adds n_email, n_card, n_ssn, n_ip, n_date, n_phone, n_replaced."""
    names = [f"n_{k}" for k in KINDS]
    added = [T.StructField(n, T.LongType()) for n in [*names, "n_replaced"]]
    taken = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType(kept + added)
    arrow = to_arrow_schema(schema)
    Feistel(key)  # a bad key fails here, not in a task

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for part in slices(batches, text):
            done = [pseudonymise(f, t) for t in part.column(text).to_pylist()]
            columns = {c.name: part.column(c.name) for c in kept}
            columns[text] = pa.array([t for t, _ in done], arrow.field(text).type)
            for kind, name in zip(KINDS, names, strict=True):
                columns[name] = pa.array([c[kind] for _, c in done], pa.int64())
            columns["n_replaced"] = pa.array([sum(c.values()) for _, c in done], pa.int64())
            yield pa.RecordBatch.from_arrays([columns[c.name] for c in arrow], schema=arrow)

    return small_batches(docs).select(*[f"`{c.name}`" for c in kept]).mapInArrow(run, schema)
