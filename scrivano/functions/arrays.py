"""List literals and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivano.functions.text import col


def listed(c: str | Column) -> Column:
    """Array of a list literal, else of parts at `;`, else at `|`, else the value alone; blank gives an empty array.

    For fields with other separators see `operators.packed_fields`."""
    s = F.trim(F.coalesce(col(c), F.lit("")))
    parts = F.when(F.contains(s, F.lit(";")), F.split(s, ";")).when(F.contains(s, F.lit("|")), F.split(s, r"\|")).otherwise(F.array(s))
    clean = F.filter(F.transform(F.coalesce(F.when(s.startswith("["), F.from_json(s, "array<string>")), parts), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(s == "", F.array().cast("array<string>")).otherwise(clean)


def notice_key(url: str | Column, attachments: Column, *fields: str | Column) -> Column:
    """Identity of a notice: its address, else its first attachment, else a hash of its fields."""
    rest = F.sha1(F.concat_ws("|", *(F.coalesce(col(f), F.lit("")) for f in fields)))
    return F.coalesce(F.nullif(col(url), F.lit("")), F.try_element_at(attachments, F.lit(1)), rest)
