"""Dates held as text in several spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The days that stand for an open start and an open end.
OPEN_START, OPEN_END = "0001-01-01", "9999-12-31"


def parse_day(value: Column | str) -> Column:
    """A date from ``yyyy-MM-dd`` (a time of day after ``T`` or a blank is ignored), ``yyyyMMdd`` or ``dd/MM/yyyy``.
    Blanks around it are ignored; null, empty and unreadable text give null."""
    c = F.col(value) if isinstance(value, str) else value
    t = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.coalesce(
        F.try_to_date(F.regexp_extract(t, r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ].*)?$", 1), "y-M-d"),
        F.try_to_date(F.regexp_extract(t, r"^(\d{8})$", 1), "yyyyMMdd"),
        F.try_to_date(F.regexp_extract(t, r"^(\d{1,2}/\d{1,2}/\d{4})$", 1), "d/M/y"),
    )


def is_blank(value: Column | str) -> Column:
    """True for null, empty and all-blank text."""
    c = F.col(value) if isinstance(value, str) else value
    return c.isNull() | (F.regexp_replace(c, r"\s+", "") == "")
