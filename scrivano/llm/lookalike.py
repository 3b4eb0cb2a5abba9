"""One consistent form for texts that look the same.

Folded everywhere: full-width forms, ligatures, blanks of other kinds, invisible characters, separate accents, and the
hyphens and slashes that look like the ASCII ones. Letters are repaired by script: in a token that mixes scripts the
letters of each are counted, and all letters are brought to the script that has most if each has a look-alike there and
the result is a word of the corpus; else to the next script in the same way, at last to the script of the text, which also
settles equal counts. A word of the corpus is a token written wholly in the script of its text, so no repaired or mixed token counts.

One exit beyond mixed tokens: a token of one script in a text mostly of another ("е" alone in an Italian sentence) is
tried in the script of the text, with the same test.
Left as they are: case, accents, digits, superscripts, fractions, other punctuation marks and line breaks.

Defined results: null stays null, empty and blank texts are no cases, repeated rows give pairs like any others.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from scrivano.session import written

# Letters of other scripts and the Latin letters they look like.
CYRILLIC = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅԚԜ", "aeopcyxijshdqwABEKMHOPCTYXIJSQW"))
GREEK = dict(zip("οΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oABEZHIKMNOPTYX"))
# Signs that look like an ASCII sign, and ligatures.
SIGNS = {"∕": "/", "‐": "-", "‑": "-"}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

TO_LATIN = CYRILLIC | GREEK
TWINS = {"latin": TO_LATIN, "cyrillic": {v: k for k, v in CYRILLIC.items()}, "greek": {v: k for k, v in GREEK.items()}}
FOLD = str.maketrans({**{chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}, **SIGNS, **LIGATURES, "\t": " "})
INVISIBLE = regex.compile(r"[\p{Cf}͏︀-️ᅟᅠ឴឵ㅤﾠ]+")
BLANK = regex.compile(r"\p{Zs}")
SCRIPTS = {"latin": regex.compile(r"\p{Latin}"), "cyrillic": regex.compile(r"\p{Cyrillic}"), "greek": regex.compile(r"\p{Greek}")}
FOREIGN = re.compile("[\u0370-\u052f\u1c80-\u1c88\u1d26-\u1d2b\u1f00-\u1fff\u2de0-\u2dff\ua640-\ua69f]")
WORD = regex.compile(r"[\p{L}\p{M}\p{N}_]+")
# Characters of texts that are surely in their form already; any other sends a text through `folded`.
OTHER = r"[^\n -~\u00A1-\u00AC\u00AE-\u024F\u2013-\u201F\u2026\u20AC]"


def fold(text: str) -> str:
    """All but the letters of other scripts."""
    text = INVISIBLE.sub("", text).replace("\r\n", "\n")
    return unicodedata.normalize("NFC", BLANK.sub(" ", text.translate(FOLD)))


def has_foreign(text: str) -> bool:
    """Whether a text has letters of other scripts; most texts are told by the range of their characters."""
    if text.isascii():
        return False
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return bool((codes >= 0x370).any()) and FOREIGN.search(text) is not None


def dominant(text: str) -> str:
    """The script of most letters of a text."""
    return max(SCRIPTS, key=lambda k: len(SCRIPTS[k].findall(text)))


def repaired(token: str, script: str) -> list[str]:
    """Forms of a token in one script, the most dominant first; `script` is that of the text."""
    parts = unicodedata.normalize("NFD", token)
    letters = {k: set(rx.findall(parts)) for k, rx in SCRIPTS.items()}
    have = {k: len(rx.findall(parts)) for k, rx in SCRIPTS.items() if letters[k]}
    wanted = sorted({*have, script}, key=lambda k: (-have.get(k, 0), k != script)) if len(have) > 1 else [script] if have and script not in have else []
    out = []
    for k in wanted:
        table = {}
        for c in set().union(*letters.values()) - letters[k]:
            latin = TO_LATIN.get(c, c)
            table[c] = latin if k == "latin" and c != latin else TWINS[k].get(latin) if k != "latin" else None
        if None not in table.values():
            out.append(unicodedata.normalize("NFC", "".join(table.get(c, c) for c in parts)))
    return out


def candidates(text: str) -> list[tuple[str, int, str]]:
    """Tokens of a folded text that may be repaired, with their forms by rank."""
    if not has_foreign(text):
        return []
    script = dominant(text)
    return [(token, n, to) for token in sorted(set(WORD.findall(text))) if script != "latin" or FOREIGN.search(token) for n, to in enumerate(repaired(token, script))]


def own_words(text: str) -> set[str]:
    """Tokens of a text that are written in the text's script."""
    rough = set(text.split())
    words = {w for x in rough for w in (WORD.findall(x) if not x.isalpha() else (x,))}
    if FOREIGN.search(text):
        script = dominant(text)
        words = {w for w in words if not any(rx.search(w) for k, rx in SCRIPTS.items() if k != script)}
    return words


PAIRS = ArrayType(StructType([StructField("token", StringType()), StructField("rank", IntegerType()), StructField("repair", StringType())]))
FOLDED = StructType([StructField("text", StringType()), StructField("pairs", PAIRS)])


@F.pandas_udf(FOLDED)
def folded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in texts:
        rows = [fold(t) for t in s]
        yield pd.DataFrame({"text": rows, "pairs": [[{"token": a, "rank": n, "repair": b} for a, n, b in candidates(t)] for t in rows]}, columns=["text", "pairs"])


@F.pandas_udf(StringType())
def substituted(texts: pd.Series, pairs: pd.Series) -> pd.Series:
    out = []
    for t, own in zip(texts, pairs):
        if own is not None and len(own):
            table = {p["token"]: p["repair"] for p in sorted(own, key=lambda p: -p["rank"])}
            t = WORD.sub(lambda m: table.get(m[0], m[0]), t)
        out.append(unicodedata.normalize("NFC", t))
    return pd.Series(out, dtype=object)


def corpus_words(texts: DataFrame) -> DataFrame:
    """The different words of all texts, gathered batch by batch in the tasks before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rough: set[str] = set()
        foreign: set[str] = set()

        def words() -> pa.RecordBatch:
            out = pa.array(foreign | {w for x in rough for w in (WORD.findall(x) if not x.isalpha() else (x,))}, pa.string())
            rough.clear()
            foreign.clear()
            return pa.RecordBatch.from_arrays([out], names=["repair"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                if not has_foreign(t):
                    rough.update(t.split())
                else:
                    foreign |= own_words(t)
            if len(rough) + len(foreign) > 300_000:
                yield words()
        yield words()

    return texts.mapInArrow(run, "repair string").distinct()


def unified(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(`key`, own, form, text) of the texts with other than plain characters, where own is a hash of the text, form the
    unified text; and (`key`, own) of all others, whose form is the text.

    Only texts that are not plain go through `folded`. The vocabulary is that of all texts; of it only words that are the
    result of some repair are kept, so what is joined follows the number of repairs."""
    docs = docs.select(F.col(key), F.col(text).alias("text")).filter("text is not null")
    once = written(docs.select(key, digest("text").alias("own"), F.when(F.col("text").rlike(OTHER), F.col("text")).alias("text")), "seen")
    special = once.filter("text is not null").select(key, "own", "text", folded("text").alias("f"))
    special = written(special.select(key, "own", "text", F.col("f.text").alias("fold"), "f.pairs"), "folded")
    wanted = special.select(key, F.inline("pairs"))
    words = corpus_words(docs.select("text")).unionByName(corpus_words(special.select("fold"))).distinct()
    known = wanted.select("repair").distinct().join(words, "repair", "left_semi")
    good = wanted.join(known, "repair").groupBy(key).agg(F.collect_list(F.struct("token", "rank", "repair")).alias("good"))
    special = special.select(key, "own", "text", "fold").join(good, key, "left")
    return special.select(key, "own", "text", substituted("fold", "good").alias("form")), once.filter("text is null").select(key, "own")


def digest(c: str | Column) -> Column:
    return F.unhex(F.md5(F.encode(c, "UTF-8")))


def in_one_form(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(`key`, `text`) with every text in its form."""
    special, _ = unified(docs, key, text)
    special = special.select(key, F.col("form").alias("_form"))
    return docs.select(key, text).join(special, key, "left").select(key, F.coalesce("_form", text).alias(text))


def same_look(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs (doc_a, doc_b) of different texts with one form. At least one text of a pair is not in its form, so pairs are
    made from these texts only, and only hashes of the others are moved."""
    special, plain = unified(docs, key, text)
    special = special.filter(F.col("form").rlike(r"\S")).select(F.col(key).alias("doc"), digest("form").alias("form"), "own")
    special = written(special, "forms")
    changed = special.filter("form != own")
    wanted = changed.select("form").distinct()
    same = plain.select(F.col(key).alias("doc"), F.col("own").alias("form"), "own").unionByName(special.filter("form = own"))
    same = same.join(wanted, "form", "left_semi")
    others = same.withColumn("changed", F.lit(False)).unionByName(changed.withColumn("changed", F.lit(True)))
    pairs = changed.alias("a").join(others.alias("b"), F.expr("a.form = b.form and a.own != b.own and (not b.changed or a.doc < b.doc)"))
    return pairs.select(F.least("a.doc", "b.doc").alias("doc_a"), F.greatest("a.doc", "b.doc").alias("doc_b")).distinct()
