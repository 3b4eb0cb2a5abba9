"""Operational measures: counters, gauges, operations, caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tags_key(tags: str | Column) -> Column:
    """Stable text of a map of tags; null as an empty map."""
    m = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ","), F.lit(""))


def running(points: DataFrame, by: list[str], order: list[str], value: str, slots: int = 0) -> DataFrame:
    """Running sum of a counter in time order, in two steps so that a busy counter is no single task: sums of time slots
    are added up first, then the points of each slot run on from the sum before it."""
    amount = F.coalesce(F.col(value), F.lit(0.0)).cast("decimal(28,4)")
    cut = points.withColumn("_slot", F.date_trunc("day", F.col(order[0]))).withColumn("_v", amount)
    sums = cut.groupBy(*by, "_slot").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    own = Window.partitionBy(*by, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.withColumn("_own", F.sum("_v").over(own))
    on = F.lit(True)
    for c in [*by, "_slot"]:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    out = out.alias("a").join(sums.alias("b"), on)
    return out.select(*(F.col(f"a.{c}") for c in points.columns), (F.col("_own") + F.col("_before")).cast("double").alias("running"))


def gauges(points: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Last value of each gauge."""
    return points.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("value"))


def operations(df: DataFrame, name: str, duration: str, success: Column) -> DataFrame:
    seconds = F.coalesce(F.sum(F.col(duration).cast("decimal(28,4)")), F.lit(0))
    n, good = F.count("*"), F.count_if(success)
    return df.groupBy(name).agg(n.alias("count"), seconds.cast("double").alias("total"), good.alias("successes"), (n - good).alias("failures"), F.round(seconds / n, 6).cast("double").alias("average"), F.round(good / n, 6).alias("success_rate"))


def hit_rate(df: DataFrame, hit: Column) -> DataFrame:
    n, good = F.count("*"), F.count_if(hit)
    return df.agg(good.alias("hits"), (n - good).alias("misses"), F.when(n == 0, 0.0).otherwise(F.round(good / n, 6)).alias("hit_rate"))


def least_recently_used(log: DataFrame, key: str, time: str, keep: int) -> DataFrame:
    """Keys that a cache of `keep` entries has dropped: all but those used last."""
    last = log.groupBy(key).agg(F.max(time).alias("last_used"))
    kept = last.orderBy(F.desc("last_used"), key).limit(keep)
    return last.join(kept.select(key), key, "left_anti")
