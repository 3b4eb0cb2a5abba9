"""Joins of new rows against what is already known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suffixed_join(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Inner join; columns of the right side that both have get the suffix."""
    renamed = right.select(*(F.col(c).alias(c if c == key or c not in left.columns else f"{c}{suffix}") for c in right.columns))
    return left.join(renamed, key, "inner")


def updated(df: DataFrame, changes: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """`columns` of `df` replaced where `changes` has the key; of several changes the last in `order` counts."""
    last = changes.groupBy(key).agg(*(F.max_by(c, order).alias(f"_{c}") for c in columns), F.lit(True).alias("_hit"))
    out = df.join(last, key, "left")
    return out.select(*(F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def seen_keys(known: DataFrame, *keys: str | Column) -> DataFrame:
    """Every key under which a known row may come back."""
    out = None
    for k in keys:
        one = known.select((F.col(k) if isinstance(k, str) else k).alias("seen")).filter(F.col("seen").isNotNull() & (F.col("seen") != ""))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def unseen(df: DataFrame, seen: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each key that is not seen yet. The anti join comes before the keys are grouped, so seen rows are not moved twice."""
    new = df.join(seen.select(F.col("seen").alias(key)), key, "left_anti").filter(F.col(key).isNotNull())
    rest = [c for c in df.columns if c != key]
    first = new.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return first.select(key, "_r.*").select(*df.columns)


def split_processed(df: DataFrame, done: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows to be used again, and rows to be processed."""
    keys = done.select(key).filter(F.col(key).isNotNull()).distinct()
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def with_failures(done: DataFrame, failed: DataFrame) -> DataFrame:
    """Union of full rows and failure rows, which lack most columns."""
    return done.unionByName(failed, allowMissingColumns=True)


def with_text(records: DataFrame, texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Text of each record, empty where there is none."""
    return records.join(texts.select(key, text), key, "left").withColumn(text, F.coalesce(text, F.lit("")))


def unexpired(memo: DataFrame, now: Column, expires: str = "expires_at") -> DataFrame:
    """Entries of a memo table that may still be used."""
    return memo.filter(F.col(expires).isNull() | (F.col(expires) >= now))
