"""Several values packed in one field: a quote-aware finite-state tokenizer.

States: before a value, in a bare value, in a quoted value. Outside quotes `,` `;` `|` tabs, line breaks,
`<br>` and running numbers such as `2) ` separate values; brackets of a list literal open and close a level.
Defined results: null, blank and empty-list fields give no value; blank values are not counted; repeated values
keep their places; a quote that is never closed is dropped and what follows is read as bare; a list whose bracket
is never closed ends with the field.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

BREAK = re.compile(r"\|\||<br\s*/?>|[\t\r\n]|[,;|]", re.I)
NUMBER = re.compile(r"\d{1,4}[)]\s+")
BARE_STOP = re.compile(r"\|\||<br\s*/?>|[\t\r\n,;|\])]|\s(?=\d{1,4}[)]\s)", re.I)
EXTENSION = re.compile(r"\.[A-Za-z][A-Za-z0-9]{1,4}(?:[?#;].*)?$", re.S)
PARAMETER = re.compile(r"[\w.%+&-]*(?:=[\w.%+&=-]*)?\Z")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
CLOSERS = {"[": "]", "(": ")"}


def _quoted(s: str, i: int, q: str, depth: int) -> tuple[str, int] | None:
    """Value and end of the quoted value that opens at `i`, or None if it never closes."""
    out, j, n = [], i + 1, len(s)
    while j < n:
        c = s[j]
        if c == "\\" and j + 1 < n and (depth or s[j + 1] in "\"'\\"):
            e = s[j + 1]
            if e == "u" and re.fullmatch(r"[0-9a-fA-F]{4}", s[j + 2 : j + 6]):
                out.append(chr(int(s[j + 2 : j + 6], 16)))
                j += 6
                continue
            out.append(ESCAPES.get(e, e))
            j += 2
            continue
        if c == q:
            k = j + 1
            while k < n and s[k] in " \u00a0":
                k += 1
            ends = k == n or depth and s[k] in "])" or BREAK.match(s, k) or NUMBER.match(s, k)
            if s.startswith(q, j + 1) and not (depth and ends):
                out.append(q)
                j += 2
                continue
            if ends:
                return "".join(out), j + 1
        out.append(c)
        j += 1
    return None


def _continues(s: str, start: int, at: int, end: int) -> bool:
    """Whether the `,` `;` or `|` at `at` is part of the value from `start` on: a parameter follows, or it is no whole name yet."""
    if s[at:end] not in (",", ";", "|"):
        return False
    m = BARE_STOP.search(s, end)
    chunk = s[end : m.start() if m else len(s)]
    if not chunk.strip():
        return False
    value = s[start:at]
    if EXTENSION.search(value.strip()):
        tail = re.split(r"[?;]", value)[1:]
        glued = value == value.rstrip() and chunk == chunk.lstrip() and not EXTENSION.search(chunk.strip())
        return glued and bool(PARAMETER.match(chunk.rstrip())) and ("=" in chunk or bool(tail) and "=" in tail[-1])
    whole = chunk.strip()
    return bool(EXTENSION.search(whole)) and "/" not in whole and "." in value


def tokenize(s: str | None) -> list[str]:
    """Values of one field, in order."""
    out: list[str] = []
    if not s:
        return out
    i, n, levels = 0, len(s), []
    while i < n:
        c = s[i]
        if c.isspace() or c == "﻿":
            i += 1
        elif m := BREAK.match(s, i):
            i = m.end()
        elif c in CLOSERS and (levels or not out):
            levels.append(CLOSERS[c])
            i += 1
        elif levels and c == levels[-1]:
            levels.pop()
            i += 1
        elif m := NUMBER.match(s, i):
            i = m.end()
        else:
            if c in "\"'":
                if got := _quoted(s, i, c, len(levels)):
                    value, i = got
                    if value.strip():
                        out.append(value.strip())
                    continue
                i += 1
            start = i
            while i < n:
                m = BARE_STOP.search(s, i)
                if not m:
                    i = n
                elif m[0] in "])" and m[0] not in levels or m[0].lower()[:1] in ",;|" and m[0] != "||" and _continues(s, start, m.start(), m.end()):
                    i = m.end()
                    continue
                else:
                    i = m.start()
                break
            value = s[start:i].strip()
            if value and not (levels and value in ("null", "None")):
                out.append(value)
    return out


@F.pandas_udf(ArrayType(StringType()))
def packed_values(fields: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Array of the values of each field."""
    for s in fields:
        yield s.map(tokenize, na_action="ignore")


def split_packed(df: DataFrame, field: str | Column, key: str, position: str = "posizione", value: str = "valore") -> DataFrame:
    """One row per value of `field`, with `key` and the place counted from 1. Other columns of `df` are not read."""
    c = F.col(field) if isinstance(field, str) else field
    rows = df.select(F.col(key), c.alias("_field")).filter(F.length(F.trim("_field")) > 0)
    rows = rows.select(key, F.posexplode(packed_values("_field")).alias("_at", value))
    return rows.select(key, (F.col("_at") + 1).cast("bigint").alias(position), value)
