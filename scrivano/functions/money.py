"""Amounts of money in Italian texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivano.functions.text import col

# The three ways in which an amount is written, case-sensitive, in the order in which they are read.
AMOUNTS = (r"€\s*([0-9.,]+)", r"(?:importo|totale|spesa complessiva|impegno di spesa|per\s+un\s+importo\s+di)\s+€?\s*([0-9.,]+)", r"euro\s*([0-9.,]+)")


def amount(c: str | Column) -> Column:
    """Number of a written amount. With both signs the comma is the decimal sign, alone each is; others give null."""
    s = F.regexp_replace(F.trim(col(c)), "[ ']", "")
    dot, comma = F.contains(s, F.lit(".")), F.contains(s, F.lit(","))
    s = F.when(dot & comma, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(comma, F.replace(s, F.lit(","), F.lit("."))).otherwise(s)
    return F.when(s.rlike(r"^[0-9.]+$"), s.try_cast("double"))


def amounts(c: str | Column) -> Column:
    """All amounts of a text; one that two ways match stands twice."""
    t = F.coalesce(col(c), F.lit(""))
    found = F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in AMOUNTS))
    return F.filter(F.transform(found, amount), lambda x: x.isNotNull())
