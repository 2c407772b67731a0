"""Ids, money and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed(prefix: str, number: Column | str) -> Column:
    """Id such as user_1234."""
    return F.concat(F.lit(prefix), _col(number).cast("string"))


def cents(amount: Column | str) -> Column:
    """Amount in whole cents, through an exact decimal; NULL where that has no room."""
    return (_col(amount).try_cast("decimal(18,2)") * 100).try_cast("int")


def cents_lost(amount: Column | str) -> Column:
    """True for an amount that has no value in cents."""
    return _col(amount).isNotNull() & cents(amount).isNull()


def utf8_bytes(text: Column | str) -> Column:
    return F.encode(text, "UTF-8")


def utf8_text(raw: Column | str) -> Column:
    return F.decode(raw, "UTF-8")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
