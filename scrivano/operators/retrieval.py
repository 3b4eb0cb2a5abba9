"""Chunks of texts, lexical and vector search, prompts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from scrivano.functions.text import col, compact, tokens

SIZE, OVERLAP, TOP, LEAST_CHARS, BLOCK, TEXTS, VECTORS = 3000, 300, 6, 50, 1024, 8192, 8192
SEPARATORS = ("\n\n", "\n", ".", " ")


def fixed_chunks(docs: DataFrame, key: str, text: str = "text", size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(`key`, chunk_no, chunk) windows of equal size; texts under 50 characters give none."""
    docs = docs.filter(F.length(text) >= LEAST_CHARS)
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1 - overlap, F.lit(0)), F.lit(size - overlap))
    return docs.select(key, text, F.posexplode(starts).alias("chunk_no", "_s")).select(key, F.col("chunk_no").cast("bigint").alias("chunk_no"), F.substring(F.col(text), F.col("_s") + 1, F.lit(size)).alias("chunk"))


def split_text(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Parts of at most `size` characters that end at the coarsest separator possible; each begins with up to `overlap` of the last."""
    if len(text) <= size:
        return [text] if text.strip() else []
    rest = separators
    while rest and rest[0] not in text:
        rest = rest[1:]
    if not rest:
        return [p for i in range(0, max(1, len(text) - overlap), size - overlap) if (p := text[i : i + size]).strip()]
    sep, finer = rest[0], rest[1:]
    pieces = [p + sep for p in text.split(sep)]
    pieces[-1] = pieces[-1][: -len(sep)]
    out: list[str] = []
    now: list[str] = []
    length = 0
    for p in pieces:
        if len(p) > size:
            if now:
                out.append("".join(now))
                now, length = [], 0
            out += split_text(p, size, overlap, finer)
            continue
        if length + len(p) > size:
            out.append("".join(now))
            while now and (length > overlap or length + len(p) > size):
                length -= len(now.pop(0))
        now.append(p)
        length += len(p)
    if now and "".join(now).strip():
        out.append("".join(now))
    return out


@F.pandas_udf(ArrayType(StringType()))
def split_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(split_text, na_action="ignore")


def recursive_chunks(docs: DataFrame, key: str, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(`key`, the columns `keep`, chunk_no, chunk) parts by the coarsest separators; texts under 50 characters give none."""
    docs = docs.filter(F.length(text) >= LEAST_CHARS)
    return docs.select(key, *keep, F.posexplode(split_texts(text)).alias("chunk_no", "chunk")).withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


def prefixed(subject: Column, cig: Column, cup: Column, chunk: Column) -> Column:
    """Chunk with the act's subject and codes before it."""
    part = lambda label, c, n=10_000: F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.lit(f"{label}: "), F.substring(c, 1, n)))
    head = F.concat_ws(". ", part("Oggetto", subject, 250), part("CIG", cig), part("CUP", cup))
    return F.when(head == "", chunk).otherwise(F.concat(head, F.lit(".\n\n"), chunk))


def prefixed_chunks(docs: DataFrame, key: str, text: str = "text", subject: str = "oggetto", cig: str = "cig", cup: str = "cup") -> DataFrame:
    """(`key`, chunk_no, chunk): every recursive chunk of every text, each with its act's subject and codes before it."""
    parts = recursive_chunks(docs, key, text, (subject, cig, cup))
    return parts.select(key, "chunk_no", prefixed(F.nullif(compact(subject), F.lit("N/D")), F.col(cig), F.col(cup), F.col("chunk")).alias("chunk"))


def blocks_of(rows: DataFrame, key: str, most: int, least: int = BLOCK, n: int | None = None) -> tuple[DataFrame, int]:
    """Adds `b`, a number of a block of about `most` rows (of `n`, if that is known); small tables get as many blocks as there are shuffle partitions,
    if each then has `least` rows. The larger the blocks the less is copied."""
    n = rows.count() if n is None else n
    spread = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // least))
    n = max(1, -(-n // most), spread)
    return rows.withColumn("b", F.pmod(F.xxhash64(key), F.lit(n))), n


def best_of(scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` smallest scores of each row, ties by place."""
    k = min(top, scores.shape[1])
    if k == scores.shape[1]:
        return np.argsort(scores, axis=1, kind="stable")
    edge = np.partition(scores, k - 1, axis=1)[:, k - 1 : k]
    return np.stack([(near := np.flatnonzero(row <= e))[np.argsort(row[near], kind="stable")[:k]] for row, e in zip(scores, edge)])


def overlap_search(questions: DataFrame, question: str, docs: DataFrame, key: str, text: str = "text", query_key: str = "question_id", top: int = TOP) -> DataFrame:
    """Rows with most tokens in common with each question, ties by key.

    Words that nearly all questions and texts have would make a join of tokens give nearly all pairs, so texts and
    questions are packed into blocks of their tokens' hashes, and each pair of blocks is one product of two 0/1 matrices over
    the tokens of the questions, which leaves `top` rows a question."""
    hashes = lambda c: F.transform(tokens(c), lambda x: F.xxhash64(x))
    rows, n = blocks_of(docs.select(F.col(key).alias("id"), hashes(text).alias("t")).filter("size(t) > 0"), "id", TEXTS, TEXTS // 32, docs.count())
    asked = questions.select(F.col(query_key).alias("id"), hashes(question).alias("t")).filter("size(t) > 0")
    asked, _ = blocks_of(asked, "id", BLOCK, BLOCK, questions.count())
    blocks = rows.groupBy("b").agg(F.collect_list(F.struct("id", "t")).alias("rows"))
    asked = asked.groupBy(F.col("b").alias("qb")).agg(F.collect_list(F.struct("id", "t")).alias("asked"))
    met = blocks.join(asked.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))), "b")

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for own, ask in zip(pdf["rows"], pdf["asked"]):
                own = sorted(own, key=lambda r: r["id"])
                words = np.unique(np.concatenate([r["t"] for r in ask]))
                a, ids = np.zeros((len(ask), len(words)), np.float32), np.array([r["id"] for r in own])
                for i, r in enumerate(ask):
                    a[i, np.searchsorted(words, r["t"])] = 1
                b = np.zeros((len(words), len(own)), np.float32)
                for j, r in enumerate(own):
                    at = np.searchsorted(words, r["t"]).clip(max=len(words) - 1)
                    b[at[words[at] == r["t"]], j] = 1
                common = a @ b
                best = best_of(-common, top)
                for i, r in enumerate(ask):
                    k = best[i][common[i, best[i]] > 0]
                    yield pd.DataFrame({query_key: r["id"], key: ids[k], "overlap": common[i, k].astype(np.int64)})

    kinds = f"`{query_key}` {questions.schema[query_key].dataType.simpleString()}, `{key}` {docs.schema[key].dataType.simpleString()}, overlap bigint"
    hits = met.mapInPandas(nearest, kinds)
    w = Window.partitionBy(query_key).orderBy(F.desc("overlap"), key)
    return hits.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= top)


def vector_search(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", top: int = TOP, cosine: bool = False) -> DataFrame:
    """Nearest rows of every row that `queries` marks, by exact distance over all rows, the row itself excepted.

    Rows are packed into blocks of about `VECTORS`; each pair of a query block and a block is one matrix product, which leaves
    `top` rows a query, so neither side is sent whole to a task. Distances are rounded to 4 places, ties go by key."""
    rows = vectors.filter(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    packed, n = blocks_of(rows, "id", VECTORS)
    blocks = packed.groupBy("b").agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    asked = packed.filter("q").groupBy("b").agg(F.collect_list(F.struct("id", "v")).alias("asked")).withColumnRenamed("b", "qb")
    met = blocks.join(asked.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))), "b")

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for own, ask in zip(pdf["rows"], pdf["asked"]):
                a, b = np.array([r["v"] for r in ask], float), np.array([r["v"] for r in own], float)
                qi, di = np.array([r["id"] for r in ask]), np.array([r["id"] for r in own])
                if cosine:
                    d = 1 - (a @ b.T) / np.maximum(np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :], 1e-12)
                else:
                    d = ((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None, :]).clip(min=0)
                d = np.where(qi[:, None] == di[None, :], np.inf, d)
                order = np.argsort(di, kind="stable")
                di, d = di[order], np.round(d[:, order], 4)
                best = best_of(d, top)
                for i in range(len(qi)):
                    k = best[i][np.isfinite(d[i][best[i]])]
                    yield pd.DataFrame({"query_id": qi[i], "vec_id": di[k], "distance": np.round(d[i][k], 4)})

    near = met.mapInPandas(nearest, "query_id bigint, vec_id bigint, distance double")
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return near.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= top)


TEMPLATE = "Rispondi solo in base al contesto.\n\nContesto:\n{context}\n\nDomanda: {question}\nRisposta:"


def prompts(hits: DataFrame, query_key: str, question: str, passage: str, rank: str = "rank") -> DataFrame:
    """Prompt of each question from its passages in order of rank."""
    parts = hits.groupBy(query_key, question).agg(F.array_sort(F.collect_list(F.struct(rank, passage))).alias("_p"))
    context = F.array_join(F.transform("_p", lambda p: p[passage]), "\n\n")
    before, _, after = TEMPLATE.partition("{context}")
    middle, _, end = after.partition("{question}")
    return parts.select(query_key, F.concat(F.lit(before), context, F.lit(middle), col(question), F.lit(end)).alias("prompt"))
