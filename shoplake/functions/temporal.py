"""Dates and times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(moment: Column | str) -> Column:
    return F.to_date(moment)


def date_text(day: Column | str) -> Column:
    """Date as yyyy-MM-dd."""
    return F.date_format(day, "yyyy-MM-dd")


def iso_text(moment: Column | str) -> Column:
    """Time as ISO-8601 text with six fraction digits and no zone."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def as_date(day: dt.date | str) -> dt.date:
    """A date argument, checked before it reaches a query."""
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
