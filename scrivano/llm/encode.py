"""Encoding of texts with a public byte-level BPE vocabulary by dynamic programming over byte prefixes.

For every prefix of a piece exactly one token can end it validly: the token `t` whose start is reached by a prefix
ending in a token `p` such that BPE encodes the bytes of `p` and `t` as just these two. The table of these last tokens
is filled from left to right and read back from the end. It makes appends exact (old entries never change) and lets an
edit stop as soon as its entries agree again with the old ones.

Defined results: null and empty texts give an empty list; strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

BYTE_BPE_50K = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # the default; any path that all executors can read will do
# Fixed value: how this vocabulary cuts texts into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_PIECES = 400_000


class Vocabulary:
    """Ranks of a public vocabulary file, whose ids are also the order of its merges."""

    def __init__(self, path: str = BYTE_BPE_50K):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self._pairs: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """BPE by its definition: always merge the leftmost pair of lowest rank."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, p: int, t: int) -> bool:
        """Whether BPE keeps the bytes of `p` and `t`, side by side, as these two tokens."""
        known = self._pairs.get((p, t))
        if known is None:
            if len(self._pairs) > 2_000_000:
                self._pairs.clear()
            known = self._pairs[p, t] = self.merged(self.tokens[p] + self.tokens[t]) == [p, t]
        return known


class PrefixTable:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _last(self, data: bytes, end: int, last: list[int]) -> int:
        v = self.vocabulary
        for n in range(min(v.longest, end), 0, -1):
            t = v.ranks.get(data[end - n : end])
            if t is not None and (n == end or v.follows(last[end - n - 1], t)):
                return t
        raise ValueError("a byte is missing from the vocabulary")

    def append(self, more: bytes) -> PrefixTable:
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._last(self.data, end, self.last))
        return self

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replaces bytes `start` to `stop`; returns how many entries had to be computed again."""
        old, shift = self.last, len(new) - (stop - start)
        data, last, same, done = self.data[:start] + new + self.data[stop:], self.last[:start], 0, 0
        for end in range(start + 1, len(data) + 1):
            last.append(self._last(data, end, last))
            done += 1
            beyond = end > start + len(new) and last[-1] == old[end - 1 - shift]
            same = same + 1 if beyond else 0
            if same >= self.vocabulary.longest:
                last += old[end - shift :]
                break
        self.data, self.last = data, last
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            t = self.last[end - 1]
            out.append(t)
            end -= len(self.vocabulary.tokens[t])
        return out[::-1]


class _Cache(dict):
    """Ids of each different piece, computed once in a task."""

    def __init__(self, of: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.of = of

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) > CACHED_PIECES:
            self.clear()
        out = self[piece] = self.of(piece)
        return out


class Encoder:
    """Texts to ids. `append` and `edit` re-encode only from the last white space before the change to the next after it."""

    def __init__(self, path: str = BYTE_BPE_50K):
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(PIECES).findall
        self.known = _Cache(lambda piece: tuple(PrefixTable(self.vocabulary, piece.encode("utf-8", "surrogatepass")).ids()))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self.split(text)))) if text else []

    def encoded(self, text: str) -> tuple[str, list[int], list[tuple[int, int]]]:
        """Text, ids and the places (character, id) where a run of white space begins: there pieces always end."""
        ids: list[int] = []
        marks, at = [(0, 0)], 0
        for piece in self.split(text):
            if piece[0].isspace() and at and not text[at - 1].isspace():
                marks.append((at, len(ids)))
            ids += self.known[piece]
            at += len(piece)
        return text, ids, marks

    def edit(self, state: tuple[str, list[int], list[tuple[int, int]]], start: int, stop: int, new: str) -> tuple[str, list[int], list[tuple[int, int]]]:
        """The state after characters `start` to `stop` became `new`."""
        text, ids, marks = state
        first = next(m for m in reversed(marks) if m[0] < start or m[0] == 0)
        after = next((m for m in marks if m[0] > stop), (len(text), len(ids)))
        middle = self.encoded(text[first[0] : start] + new + text[stop : after[0]])
        chars, grown = len(middle[0]) + first[0], len(middle[1]) + first[1]
        kept = [m for m in marks if m[0] <= first[0]] + [(a + first[0], b + first[1]) for a, b in middle[2][1:]]
        kept += [(a - after[0] + chars, b - after[1] + grown) for a, b in marks if a >= after[0]]
        return text[: first[0]] + middle[0] + text[after[0] :], ids[: first[1]] + middle[1] + ids[after[1] :], kept

    def append(self, state: tuple[str, list[int], list[tuple[int, int]]], more: str) -> tuple[str, list[int], list[tuple[int, int]]]:
        return self.edit(state, len(state[0]), len(state[0]), more)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(path)


def encode_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """`key` and `ids`, the tokens of each text. No shuffle: each batch is encoded where it was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            split, known, ends, parts = e.split, e.known.__getitem__, [0], []
            for t in batch.column(1).to_pylist():
                if t:
                    parts.append(np.fromiter(chain.from_iterable(map(known, split(t))), np.int32))
                ends.append(ends[-1] + (len(parts[-1]) if t else 0))
            values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """`key` and `tokens`, the number of tokens of each text (0 for null and empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        length = _Cache(lambda piece: len(e.known[piece]))
        for batch in batches:
            counts = [sum(map(length.__getitem__, e.split(t))) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=[key, "tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, tokens bigint")
