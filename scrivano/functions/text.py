"""Text functions: normalisation, features, slugs, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
LATIN_TOKEN = r"[A-Za-zÀ-ÖØ-öø-ÿ0-9_]+"
SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]+"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compact(c: str | Column) -> Column:
    """White space of any kind collapsed to one blank; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACE, " "))


def normalized(c: str | Column) -> Column:
    """As `compact`, with control characters read as blanks."""
    return compact(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]+", " "))


def words(c: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(WORD), F.lit(0))


def text_features(c: str | Column, found: str | Column | None = None) -> dict[str, Column]:
    """Eight measures of a text; null counts as empty. `found` is a column of its words, so that they are cut out once."""
    t = F.coalesce(col(c), F.lit(""))
    w = words(c) if found is None else col(found)
    same = lambda x: F.size(F.filter(w, lambda v: v == x)).cast("bigint")
    years = F.array_sort(F.array_distinct(F.filter(w, lambda v: v.rlike(r"^20[0-9]{2}$"))))
    return {
        "text_chars": F.length(t).cast("bigint"),
        "text_words": F.size(w).cast("bigint"),
        "unique_words": F.size(F.array_distinct(w)).cast("bigint"),
        "euro_mentions": F.regexp_count(F.lower(t), F.lit(r"€| euro(?![\p{L}\p{N}_])")).cast("bigint"),
        "cig_mentions": same("cig"),
        "cup_mentions": same("cup"),
        "date_mentions": F.regexp_count(t, F.lit(r"(?<![\p{L}\p{N}_])[0-9]{1,2}/[0-9]{1,2}/20[0-9]{2}(?![\p{L}\p{N}_])")).cast("bigint"),
        "years_mentioned": F.concat_ws(",", years),
    }


def slug(c: str | Column, most: int = 120) -> Column:
    """File-name form: blanks to `_`, other signs dropped, cut; `file` if nothing is left."""
    s = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACE, " ")), " ", "_")
    s = F.substring(F.regexp_replace(s, r"[^\p{L}\p{N}_\-.]+", ""), 1, most)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("file"))


def tokens(c: str | Column) -> Column:
    """Different retrieval tokens of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(LATIN_TOKEN), F.lit(0)))


def snippet(c: str | Column, most: int = 320) -> Column:
    return F.concat(F.substring(compact(c), 1, most), F.lit("..."))


def cache_key(c: str | Column) -> Column:
    return F.substring(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[^\p{L}\p{N}\-_]", "_"), 1, 64)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two places; 0 of nothing."""
    return F.when(whole == 0, 0.0).otherwise(F.round(part.cast("double") / whole * 100, 2))


def priority(part: Column, whole: Column) -> Column:
    share = F.when(whole == 0, 0.0).otherwise(part / whole)
    return F.when(part == 0, 4).when(share >= 0.25, 1).when(share >= 0.10, 2).otherwise(3)
