"""Filling containers of fixed capacity: exact complements first, then best fit.

Only how many items have each length matters for the filling, so the plan is made on the histogram of lengths: at most
`capacity` rows, whatever the number of texts. Each step of the plan takes as many equal containers as the counts
allow and uses up one length or one group of containers, hence at most 8 x capacity slots. Texts then find their slot by their rank among the texts of the same length. Ranks are counted in salted
groups, so that a length shared by a third of all texts is no single task;
there are the more groups the more texts there are.

Defined results: a text longer than the capacity is cut into parts of just the capacity and a remainder; no other text
is split. Texts without tokens (null, empty) take no space: one row with `contenitore` null and `lunghezza` 0.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrivano.session import written

SALTS, RANKED = 64, 500_000  # groups of a length, and texts that one of them may have


class _Sums:
    """Which sums a pair of available lengths can have. A sum that is marked may have been used up since; none is missed."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.misses = counts, 0
        self.refresh()

    def refresh(self) -> None:
        c = self.counts
        self.misses, n = 0, len(c)
        self.pairs = np.zeros(n, bool)
        there = c > 0
        for x in np.flatnonzero(there):
            self.pairs[x:] |= there[: n - x]

    def pair(self, total: int, at_most: int) -> tuple[int, ...] | None:
        """The pair of this sum with the largest item, no item above `at_most`."""
        c = self.counts
        low = np.arange(max(1, total - at_most), total // 2 + 1)
        good = (c[low] > 0) & (c[total - low] > 0) & ((low * 2 != total) | (c[low] > 1))
        k = int(good.argmax()) if len(good) else 0
        return (total - int(low[k]), int(low[k])) if len(good) and good[k] else None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that make up `gap`."""
        c = self.counts
        if c[gap] > 0:
            return (gap,)
        if self.pairs[gap] and (found := self.pair(gap, gap)):
            return found
        z = np.arange(1, gap)
        for third in z[(c[1:gap] > 0) & self.pairs[gap - z]][::-1].tolist():
            c[third] -= 1
            found = self.pair(gap - third, min(third, gap - third))
            c[third] += 1
            if found:
                return (third, *found)
            self.misses += 1
            if self.misses > 2000:
                self.refresh()
        return None


def fill_plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a container, number of such containers) for `counts` of lengths from 1 to `capacity`."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    sums, open_, plan = _Sums(left), {}, []

    def keep(items: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(items)
        if gap:
            open_.setdefault(gap, []).append((items, n))
        else:
            plan.append((items, n))

    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1
            found = sums.fill(capacity - length) if length < capacity else ()
            left[length] += 1
            if found is None:
                break
            need = Counter((length, *found))
            n = min(int(left[x]) // k for x, k in need.items())
            for x, k in need.items():
                left[x] -= n * k
            plan.append(((length, *found), n))
    gaps = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = length + int(gaps[length:].argmax())
            if gaps[at]:
                items, have = open_[at].pop()
                gaps[at] = bool(open_[at])
                m = min(n, have)
                if have > m:
                    open_[at].append((items, have - m))
                    gaps[at] = True
                keep((*items, length), m)
                gaps[at - length] = at > length
                n -= m
            else:
                each = capacity // length
                for items, m in (((length,) * each, n // each), ((length,) * (n % each), 1)):
                    if items and m:
                        keep(items, m)
                        gaps[capacity - sum(items)] = sum(items) < capacity
                n = 0
    return plan + [x for group in open_.values() for x in group]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Slots of a plan: the texts of `lunghezza` with ranks from `primo` on, `quanti` of them, go to containers from `contenitore` on.
    Each slot stands in every block of 2^`passo` ranks that it touches, so that a rank meets few slots."""
    taken: Counter[int] = Counter()
    by: dict[int, list[tuple[int, int, int]]] = {}
    first = 1
    for items, n in plan:
        for length in items:
            by.setdefault(length, []).append((taken[length], n, first))
            taken[length] += n
        first += n
    out = []
    for length, rows in by.items():
        step = max(0, (taken[length] // len(rows)).bit_length() - 1)
        for start, n, container in rows:
            for block in range(start >> step, ((start + n - 1) >> step) + 1):
                out.append((length, step, block, start, n, container))
    return pd.DataFrame(out, columns=["lunghezza", "passo", "blocco", "primo", "quanti", "contenitore"])


def pack(sizes: DataFrame, containers: DataFrame, key: str = "doc_id", size: str = "tokens", name: str = "contesto", capacity: str = "capacita") -> DataFrame:
    """Rows (`name`, `key`, parte, inizio, lunghezza, contenitore): where each part of each item lies.

    `containers` is a short table of capacities; rows without a positive capacity are left out."""
    known = containers.select(F.col(name), F.col(capacity).cast("bigint").alias("_cap")).filter("_cap > 0")
    short = known.collect()  # a stated short list
    caps = F.array(*(F.struct(F.lit(r[0]).alias(name), F.lit(r[1]).cast("bigint").alias("_cap")) for r in short))
    sizes = sizes.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("_size"))
    whole = F.expr("_size div _cap")
    # as many groups as keep each small, even if all parts had one length (as full parts have)
    rows, total = sizes.agg(F.count("*"), F.sum("_size")).first()
    salts = max(SALTS, -(-(rows + (total or 0) // max(1, min((r[1] for r in short), default=1))) // RANKED))
    parts = sizes.select(key, "_size", F.inline(caps)).select(
        name, key, "_cap", "_size", F.explode(F.sequence(F.lit(1).cast("bigint"), F.greatest(F.expr("(_size + _cap - 1) div _cap"), F.lit(1)))).alias("parte")
    )
    parts = parts.select(
        name, key, "_cap", "parte", ((F.col("parte") - 1) * F.col("_cap")).alias("inizio"),
        F.when(F.col("parte") <= whole, F.col("_cap")).otherwise(F.expr("_size % _cap")).alias("lunghezza"),
        F.pmod(F.xxhash64(key, "parte"), F.lit(salts)).cast("int").alias("_salt"),
    )
    some = parts.filter("lunghezza > 0")
    groups = some.groupBy(name, "_cap", "lunghezza", "_salt").agg(F.count("*").alias("_n"))
    groups = written(groups, "lengths")
    histogram = groups.groupBy(name, "_cap", "lunghezza").agg(F.sum("_n").alias("_n"))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        out = slots(fill_plan(dict(zip(pdf["lunghezza"].tolist(), pdf["_n"].tolist())), int(pdf["_cap"].iloc[0])))
        out.insert(0, name, pdf[name].iloc[0])
        return out

    kind = containers.schema[name].dataType.simpleString()
    planned = written(histogram.groupBy(name).applyInPandas(plan, f"`{name}` {kind}, lunghezza bigint, passo int, blocco bigint, primo bigint, quanti bigint, contenitore bigint"), "slots")
    steps = planned.select(name, "lunghezza", "passo").distinct()
    before = Window.partitionBy(name, "lunghezza").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(name, "lunghezza", "_salt", "_from")
    own = Window.partitionBy(name, "lunghezza", "_salt").orderBy(key, "parte")
    ranked = some.withColumn("_own", F.row_number().over(own) - 1).join(offsets, [name, "lunghezza", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_own") + F.col("_from")).join(F.broadcast(steps), [name, "lunghezza"])
    ranked = ranked.withColumn("blocco", F.expr("shiftright(_rank, passo)")).drop("passo")
    placed = ranked.join(planned.drop("passo"), [name, "lunghezza", "blocco"]).filter("_rank >= primo and _rank < primo + quanti")
    placed = placed.select(name, key, "parte", "inizio", "lunghezza", (F.col("contenitore") + F.col("_rank") - F.col("primo")).alias("contenitore"))
    empty = parts.filter("lunghezza = 0 and parte = 1").select(name, key, "parte", "inizio", "lunghezza", F.lit(None).cast("bigint").alias("contenitore"))
    return placed.unionByName(empty)
