"""Lines that come back in document after document of one source.

Lines are compared by identifiers of their normal form (outer white space dropped, inner white space one blank, lower
case, runs of digits equal); blank lines are passed over. What is sorted are the suffixes of the concatenated identifiers
of each source, `LONGEST` lines of each: within a document in the task that reads it, over all documents by ranges of
(source, suffix), so that a source or a line of a third of all documents is spread over many tasks. Suffixes with a common
prefix are neighbours then: a stretch of neighbours that share d lines is a block of d lines, in whatever documents it stands.

A block has to span enough different documents. Of the suffixes of one document that begin with the same d lines only the
first in order counts, which its common prefix with the suffix before it in the document tells; so the sum over a stretch
is the number of documents. Blocks that span enough are deleted wherever they stand; no line goes that is in no block.

A block longer than `LONGEST` comes out as overlapping pieces that cover the same lines.
Defined results: null and empty texts have no lines but their documents count in their source; null is a source of its
own; a line that stands twice in a document counts once; ties at the thresholds are cases; two rows with one key are two
documents, but each line comes out once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivano.session import written

LEAST_DOCUMENTS, LEAST_SHARE, LEAST_LETTERS, LONGEST = 5, 0.05, 10, 4
BROADCAST_LINES = 200_000
DOCUMENTS_AT_ONCE, BITS = 30_000, 15  # so many documents fit into one of four counts of a number
SPACE = r"\t\x0B\f\r\x{85}\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def normal_lines(text: Column) -> Column:
    """What equal lines have in common, for each line of a text."""
    c = F.regexp_replace(text, rf"[ {SPACE}]{{2,}}|[{SPACE}]", " ")
    c = F.regexp_replace(F.lower(c), r"\p{Nd}{2,}|[\p{Nd}&&[^0]]", "0")
    return F.transform(F.split(c, "\n"), lambda x: F.trim(x))


def common_prefixes(suffixes: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Lines that each sorted suffix has in common with the one before it; none where the two are `apart`."""
    equal = (suffixes[1:] == suffixes[:-1]) & (suffixes[1:] != 0) & ~apart[1:, None]
    return np.concatenate([[0], np.logical_and.accumulate(equal, axis=1).sum(axis=1)]).astype(int)


def document_suffixes(source: np.ndarray, lengths: np.ndarray, ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different suffixes of some documents: source, lines (0 after the end), and for each number of lines the documents of
    which the suffix is the first with these lines."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    suffix = np.zeros((len(ids), longest), np.int64)
    for k in range(longest):
        rest = max(len(ids) - k, 0)
        within = doc[k:] == doc[:rest]
        suffix[:rest, k] = np.where(within, ids[k:], 0)
    order = np.lexsort((*suffix.T[::-1], doc))
    suffix, doc = suffix[order], doc[order]
    shared = common_prefixes(suffix, np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool))
    depth = np.arange(1, longest + 1)
    first = (shared[: len(doc), None] < depth) & (suffix != 0)
    some = first.any(axis=1)
    suffix, source, first = suffix[some], source[doc[some]], first[some]
    order = np.lexsort((*suffix.T[::-1], source))
    suffix, source, first = suffix[order], source[order], first[order].astype(np.int64)
    if not len(source):
        return source, suffix, first
    new = np.concatenate([[True], (source[1:] != source[:-1]) | (suffix[1:] != suffix[:-1]).any(axis=1)])
    return source[new], suffix[new], np.add.reduceat(first, np.flatnonzero(new))


def stretches(source: np.ndarray, suffix: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of a piece of the suffix array: source, lines (0 after the end), documents. Given are the blocks that span
    `LEAST_DOCUMENTS`, and those at the ends of the piece, which may go on beyond it."""
    shared = common_prefixes(suffix, np.concatenate([[True], source[1:] != source[:-1]]))
    out = []
    for d in range(1, suffix.shape[1] + 1):
        start = np.flatnonzero(shared < d)
        docs = np.add.reduceat(first[:, d - 1], start)
        good = docs >= LEAST_DOCUMENTS
        good[0] = good[-1] = True
        good &= (suffix[start, d - 1] != 0) & (docs > 0)
        lines = suffix[start[good]].copy()
        lines[:, d:] = 0
        out.append((source[start[good]], lines, docs[good]))
    return tuple(np.concatenate(x) for x in zip(*out))


def blocks(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(src, lines, docs) of the blocks of documents (src, ids) that span at least `LEAST_DOCUMENTS` of a source."""
    if not 0 < longest * BITS < 64:
        raise ValueError("blocks have one to four lines")
    names = [f"s{k}" for k in range(longest)]

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), DOCUMENTS_AT_ONCE):
                part = batch.slice(at, DOCUMENTS_AT_ONCE)
                lists = part.column(1)
                lengths = np.diff(lists.offsets.to_numpy())
                source, suffix, first = document_suffixes(part.column(0).to_numpy(), lengths, lists.flatten().to_numpy(), longest)
                packed = (first << (BITS * np.arange(longest))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (source, *suffix.T, packed)], names=["src", *names, "first"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                source, *suffix, packed = (c.to_numpy() for c in batch.columns)
                first = (packed[:, None] >> (BITS * np.arange(longest))) & ((1 << BITS) - 1)
                source, lines, spanned = stretches(source, np.stack(suffix, axis=1), first)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (source, *lines.T, spanned)], names=["src", *names, "docs"])

    columns = ", ".join(f"{n} bigint" for n in ["src", *names])
    array = docs.select("src", "ids").mapInArrow(suffixes, f"{columns}, first bigint")
    array = array.repartitionByRange("src", *names).sortWithinPartitions("src", *names)
    found = array.mapInArrow(neighbours, f"{columns}, docs bigint").groupBy("src", *names).agg(F.sum("docs").alias("docs"))
    return found.filter(F.col("docs") >= LEAST_DOCUMENTS).select("src", F.filter(F.array(*names), lambda x: x != 0).alias("lines"), "docs")


def with_lines(text: str = "text", source: str = "ente") -> tuple[Column, Column]:
    """Columns src and lines (place, identifier and whether it has enough letters of each line that is not blank)."""
    letters = rf"(?:\p{{L}}[^\p{{L}}]*+){{{LEAST_LETTERS}}}"
    line = lambda x, at: F.struct(at.alias("at"), F.when(x != "", F.xxhash64(x)).alias("id"), x.rlike(letters).alias("wordy"))
    lines = F.filter(F.transform(normal_lines(F.col(text)), line), lambda x: x["id"].isNotNull())
    return F.xxhash64(source).alias("src"), lines.alias("lines")


def lines_of_blocks(docs: DataFrame) -> DataFrame:
    """(src, id) of the lines in blocks that span enough of the documents (src, lines) of their source. A source has at most
    1 / `LEAST_SHARE` times as many as a document of it has lines on average."""
    total = docs.groupBy("src").agg(F.count("*").alias("total"))
    spanning = blocks(docs.filter("size(lines) > 0").select("src", F.col("lines.id").alias("ids")))
    spanning = spanning.join(total, "src").filter(F.col("docs") >= F.col("total") * LEAST_SHARE)
    return written(spanning.select("src", F.explode("lines").alias("id")).distinct(), "blocks")


def repeated_lines(docs: DataFrame, key: str = "doc_key", text: str = "text", source: str = "ente") -> DataFrame:
    """(`key`, riga) of each line to be removed."""
    docs = written(docs.select(F.col(key).alias("doc"), *with_lines(text, source)), "lines")
    gone = lines_of_blocks(docs)
    small = gone.count() <= BROADCAST_LINES
    lines = docs.select("src", "doc", F.inline("lines")).filter("wordy").select("src", "doc", "at", "id")
    found = lines.join(F.broadcast(gone) if small else gone, ["src", "id"])
    return found.select(F.col("doc").alias(key), (F.col("at") + 1).cast("bigint").alias("riga")).distinct()


def without_repeated(docs: DataFrame, key: str = "doc_key", text: str = "text", source: str = "ente") -> DataFrame:
    """(`key`, `text`) with the repeated lines removed and nothing else changed."""
    gone = repeated_lines(docs, key, text, source).groupBy(key).agg(F.collect_set("riga").alias("_gone"))
    docs = docs.select(key, text).join(gone, key, "left")
    kept = F.expr(f"array_join(filter(split(`{text}`, '\\n'), (x, i) -> not array_contains(_gone, cast(i + 1 as bigint))), '\\n')")
    return docs.select(key, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept).alias(text))
