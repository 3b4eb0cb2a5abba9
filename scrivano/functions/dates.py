"""Dates as they are typed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivano.functions.text import col


def parse_date(c: str | Column) -> Column:
    """Date of d/m/Y, Y-m-d or Y (1 January); impossible and other dates are null."""
    s = F.trim(col(c))
    full = lambda rx, fmt: F.when(s.rlike(rx), F.try_to_date(s, fmt))
    return F.coalesce(full(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"), full(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"), full(r"^[0-9]{4}$", "yyyy"))


def within(c: str | Column, since: str | None = None, until: str | None = None) -> Column:
    """True without bounds; with one, false for dates that cannot be read."""
    d, out = parse_date(c), F.lit(True)
    if since:
        out = out & F.coalesce(d >= F.lit(since).cast("date"), F.lit(False))
    if until:
        out = out & F.coalesce(d <= F.lit(until).cast("date"), F.lit(False))
    return out


def first_of(c: str | Column, *patterns: str, group: int = 1) -> Column:
    """Group of the first pattern that matches, or null."""
    return F.coalesce(*(F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("")), p, group), F.lit("")) for p in patterns))


# How titles and file names write dates and numbers.
DATES = (r"\b([0-9]{2}/[0-9]{2}/[0-9]{4}|20[0-9]{2}-[0-9]{2}-[0-9]{2})\b", r"\b(20[0-9]{2})\b")
NUMBERS = (r"(?i)\b(?:n\.|numero|copia|originale)[_\s-]*([0-9]{1,6})\b", r"_([0-9]{1,6})_20[0-9]{2}\b", r"\b([0-9]{1,6})/20[0-9]{2}\b")


def infer_date(c: str | Column) -> Column:
    """First full date of a text, else its first year."""
    return first_of(c, *DATES)


def infer_number(c: str | Column) -> Column:
    """Number of an act in a title or file name."""
    return first_of(c, *NUMBERS)
