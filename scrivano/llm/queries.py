"""Queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivano.llm import encode, lookalike, name_variants, packing, personal, repeated_lines, scanned
from scrivano.session import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines with damage of scanned pages, by kind."""
    found = scanned.scanned(table(spark, d, "documenti_corpus"))
    return found.select("doc_key", F.inline("cases").alias("riga", "tipo"))


@query
def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The running text of the acts in whole paragraphs."""
    return scanned.scanned(table(spark, d, "documenti_corpus")).select("doc_key", "text")


def people(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed")
    fields = [rows.select(F.lit(f).alias("campo"), F.col(f).alias("nome")) for f in ("beneficiario", "responsabile")]
    return fields[0].unionByName(fields[1])


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of spellings of one entity."""
    return name_variants.variant_pairs(people(spark, d))


@query
def p4_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entity of each spelling."""
    return name_variants.variants(people(spark, d))


def with_items(spark: SparkSession, d: str) -> DataFrame:
    places = [r[0] for r in table(spark, d, "enti").select("comune").collect() if r[0]]  # a fixed table of twenty rows
    texts = table(spark, d, "documenti_corpus").select(F.lit("documenti_corpus").alias("tabella"), F.col("doc_key").alias("chiave"), "text")
    names = table(spark, d, "allegati_parsed").select(F.lit("allegati_parsed").alias("tabella"), F.col("estr_id").alias("chiave"), F.col("beneficiario").alias("text"))
    both = texts.unionByName(names).select(F.struct("tabella", "chiave").alias("key"), "text")
    return personal.personal(both, "key", "text", places)


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Items of personal data, each different one of a row once."""
    return with_items(spark, d).select("key.tabella", "key.chiave", F.inline("items").alias("tipo", "valore"))


@query
def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    """The texts with typed placeholders."""
    return with_items(spark, d).select("key.tabella", "key.chiave", "text")


@query
def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every text."""
    return encode.encode_ids(table(spark, d, "documents"))


@query
def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Container of every text, or part of a text, in each context."""
    containers = table(spark, d, "capacita_contesto")
    docs, out = table(spark, d, "documents"), None
    for (name,) in containers.select("tokenizer").distinct().collect():  # a fixed table of three rows
        if name != "byte_bpe_50k":
            raise ValueError(f"no rule is known by which {name} cuts texts into pieces")
        path = encode.BYTE_BPE_50K
        sizes = written(encode.token_counts(docs, path=path), "tokens")
        one = packing.pack(sizes, containers.filter(containers["tokenizer"] == name))
        out = one if out is None else out.unionByName(one)
    return out


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that look the same but differ in their characters."""
    return lookalike.same_look(table(spark, d, "documents"))


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines that come back in many documents of their municipality."""
    return repeated_lines.repeated_lines(table(spark, d, "documenti_corpus"))


@query
def p3_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Texts without these lines."""
    return repeated_lines.without_repeated(table(spark, d, "documenti_corpus"))


@query
def p8_unified(spark: SparkSession, d: str) -> DataFrame:
    """Every text in its one form."""
    return lookalike.in_one_form(table(spark, d, "documents"))


SQL["p3_found"] = r"""
WITH l AS (SELECT doc_key, ente, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS riga FROM documenti_corpus),
n AS (SELECT doc_key, ente, riga, regexp_replace(lower(trim(regexp_replace(line, '[\s\p{Z}\x{85}\x{0b}]+', ' ', 'g'))), '\p{Nd}+', '0', 'g') AS norm FROM l),
f AS (SELECT ente, norm FROM n WHERE length(regexp_replace(norm, '[^\p{L}]', '', 'g')) >= 10 GROUP BY ente, norm
      HAVING count(DISTINCT doc_key) >= 5 AND count(DISTINCT doc_key) >= 0.05 * (SELECT count(*) FROM documenti_corpus c WHERE c.ente IS NOT DISTINCT FROM n.ente))
SELECT n.doc_key, CAST(n.riga AS BIGINT) AS riga FROM n JOIN f ON n.ente IS NOT DISTINCT FROM f.ente AND n.norm = f.norm
"""

SQL["p3_cleaned"] = (
    SQL["p3_found"].replace("SELECT n.doc_key, CAST(n.riga AS BIGINT) AS riga FROM n JOIN f", "SELECT n.doc_key, n.riga FROM n JOIN f").replace("WITH l AS", "WITH g AS (WITH l AS")
    + """), k AS (SELECT doc_key, riga, line FROM (SELECT doc_key, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS riga FROM documenti_corpus) ANTI JOIN g USING (doc_key, riga))
SELECT c.doc_key, CASE WHEN c.text IS NOT NULL THEN coalesce(s.text, '') END AS text FROM documenti_corpus c LEFT JOIN (SELECT doc_key, string_agg(line, chr(10) ORDER BY riga) AS text FROM k GROUP BY 1) s USING (doc_key)
"""
)
