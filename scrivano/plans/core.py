"""Queries of the core operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrivano.functions import arrays, dates, money, text, urls
from scrivano.operators import classify, clean, extract, incremental, measures, ml, quality, retrieval
from scrivano.operators.packed_fields import split_packed
from scrivano.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

NORM = r"trim(regexp_replace(regexp_replace(coalesce({0}, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f]+', ' ', 'g'), '[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}]+', ' ', 'g'))"
WORDS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}_]+')"
TOKENS = r"list_distinct(regexp_extract_all(lower(coalesce({0}, '')), '[A-Za-zÀ-ÖØ-öø-ÿ0-9_]+'))"
AMOUNT = "CASE WHEN regexp_full_match({0}, '[0-9.]+') THEN try_cast({0} AS DOUBLE) END"
CLEANED_AMOUNT = "CASE WHEN s LIKE '%.%' AND s LIKE '%,%' THEN replace(replace(s, '.', ''), ',', '.') ELSE replace(s, ',', '.') END"


def query(sql: str | None = None) -> Callable:
    """Registers a query, with the SQL that must give the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every attachment of every notice on its own row."""
    return split_packed(table(spark, d, "albo_metadati"), "allegati", "atto_id", value="allegato")


# Texts


_FEATURES = r"""length(t) AS text_chars, len(ws) AS text_words, len(list_distinct(ws)) AS unique_words,
 CAST(len(regexp_extract_all(lower(t), '€| euro([^\p{L}\p{N}_]|$)')) AS BIGINT) AS euro_mentions,
 CAST(len(list_filter(ws, lambda x: x = 'cig')) AS BIGINT) AS cig_mentions, CAST(len(list_filter(ws, lambda x: x = 'cup')) AS BIGINT) AS cup_mentions,
 CAST(len(regexp_extract_all(t, '\b[0-9]{1,2}/[0-9]{1,2}/20[0-9]{2}\b')) AS BIGINT) AS date_mentions,
 array_to_string(list_sort(list_distinct(list_filter(ws, lambda x: regexp_full_match(x, '20[0-9]{2}')))), ',') AS years_mentioned"""


@query(f"WITH w AS (SELECT doc_key, coalesce(text, '') AS t, {WORDS.format('text')} AS ws FROM documenti_corpus) SELECT doc_key, {_FEATURES} FROM w")
def text_features(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documenti_corpus").select("doc_key", "text", text.words("text").alias("words"))
    return docs.select("doc_key", *(v.alias(k) for k, v in text.text_features("text", "words").items()))


@query(f"SELECT doc_key, {NORM.format('text')} AS text FROM documenti_corpus")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documenti_corpus").select("doc_key", text.normalized("text").alias("text"))


@query(f"SELECT doc_key, sha256({NORM.format('text')}) AS text_sha256, substring({NORM.format('text')}, 1, 1200) AS text_preview FROM documenti_corpus")
def fingerprint_preview(spark: SparkSession, d: str) -> DataFrame:
    t = text.normalized("text")
    return table(spark, d, "documenti_corpus").select("doc_key", F.sha2(t, 256).alias("text_sha256"), F.substring(t, 1, 1200).alias("text_preview"))


@query(
    r"""
WITH s AS (SELECT atto_id, substring(regexp_replace(replace(trim(regexp_replace(coalesce(oggetto, ''), '[\s\p{Z}]+', ' ', 'g')), ' ', '_'), '[^\p{L}\p{N}_\-.]+', '', 'g'), 1, 120) AS slug FROM albo_metadati)
SELECT atto_id, coalesce(nullif(slug, ''), 'file') AS slug FROM s"""
)
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "albo_metadati").select("atto_id", text.slug("oggetto").alias("slug"))


@query("SELECT doc_id, text FROM documents WHERE length(text) >= 50")
def min_length_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(F.length("text") >= 50).select("doc_id", "text")


@query("SELECT sha256(text) AS fingerprint, min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1")
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select(F.sha2("text", 256).alias("fingerprint"), "doc_id")
    return docs.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def _clean_sql() -> str:
    t = "coalesce(text, '')"
    for p in clean.PASSAGES:
        t = f"regexp_replace({t}, replace('{p.replace(chr(39), chr(39) * 2)}', '{{place}}', p), '', 'gis')"
    t = rf"regexp_replace(regexp_replace(regexp_replace({t}, '[ \t]+', ' ', 'g'), '\n\s*\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
    return f"""
WITH p AS (SELECT '(?:' || string_agg(replace(comune, chr(39), '[' || chr(39) || '’]'), '|' ORDER BY comune) || ')' AS p FROM enti WHERE comune IS NOT NULL),
c AS (SELECT doc_key, {t} AS text FROM documenti_corpus, p), w AS (SELECT *, {WORDS.format("text")} AS ws FROM c)
SELECT doc_key, text, CASE WHEN text <> '' THEN substring(text, 1, 1200) END AS text_preview, CASE WHEN text <> '' THEN length(text) END AS text_chars, CASE WHEN text <> '' THEN len(ws) END AS text_words, CASE WHEN text <> '' THEN len(list_distinct(ws)) END AS unique_words FROM w"""


@query(_clean_sql())
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    places = tuple(r[0] for r in table(spark, d, "enti").filter("comune is not null").select("comune").orderBy("comune").collect())  # a fixed table
    return clean.refreshed(table(spark, d, "documenti_corpus").select("doc_key", "text"), places=places)


# Distributions, profiles, scorecard

for _name, _column in (("category_distribution", "category"), ("doc_type_distribution", "doc_type"), ("source_distribution", "source"), ("confidence_distribution", "classification_confidence")):

    def _distribution(spark: SparkSession, d: str, column: str = _column) -> DataFrame:
        return quality.distribution(table(spark, d, "allegati_parsed"), column)

    _distribution.__name__ = _name
    query(f"SELECT coalesce({_column}, '<vuoto>') AS {_column}, count(*) AS count FROM allegati_parsed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30")(_distribution)


@query(
    """
SELECT category, count(pdf_name) AS docs, avg(text_words) AS text_words_mean, CAST(median(text_words) AS DOUBLE) AS text_words_median, count(importo_max) AS importo_max_count,
 CAST(coalesce(sum(CAST(importo_max AS DECIMAL(28,2))), 0) AS DOUBLE) AS importo_max_sum, avg(importi_count) AS importi_count_mean,
 CAST(coalesce(sum(CAST(accounting_relevant AS BIGINT)), 0) AS BIGINT) AS accounting_relevant_count, CAST(coalesce(sum(CAST(missing_amount_expected AS BIGINT)), 0) AS BIGINT) AS missing_amount_expected_count
FROM allegati_parsed GROUP BY category"""
)
def category_numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.numeric_profile(table(spark, d, "allegati_parsed"))


KINDS = [label for label, _ in classify.NAME_RULES] + ["Allegato", "unknown", quality.EMPTY]


@query("SELECT coalesce(category, '<vuoto>') AS category, " + ", ".join(f"count(*) FILTER (coalesce(doc_type, '<vuoto>') = '{k}') AS \"{k}\"" for k in KINDS) + " FROM allegati_parsed GROUP BY 1")
def category_kind_matrix(spark: SparkSession, d: str) -> DataFrame:
    return quality.crosstab(table(spark, d, "allegati_parsed"), "category", "doc_type", KINDS)


@query(
    """
WITH f AS (SELECT count(*) AS total, count(*) FILTER (category IS NULL) AS a, count(*) FILTER (classification_confidence = 'ambiguous') AS b, count(*) FILTER (coalesce(text_words, 0) < 120) AS c,
 count(*) FILTER (coalesce(doc_type, 'unknown') = 'unknown') AS e, count(*) FILTER (importo_max IS NULL) AS g, count(*) FILTER (coalesce(missing_amount_expected, false)) AS h,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT text_sha256 FROM allegati_parsed)) AS i FROM allegati_parsed),
m AS (SELECT count(*) AS total, count(*) FILTER (tipologia IS NULL) AS a, count(*) - (SELECT count(*) FROM (SELECT DISTINCT dettaglio_url FROM albo_metadati)) AS b FROM albo_metadati),
r AS (SELECT 'documenti_senza_categoria' AS issue, a AS count, total FROM f UNION ALL SELECT 'classificazioni_ambigue', b, total FROM f UNION ALL SELECT 'testi_troppo_corti', c, total FROM f UNION ALL
 SELECT 'tipo_documento_unknown', e, total FROM f UNION ALL SELECT 'documenti_senza_importi', g, total FROM f UNION ALL SELECT 'atti_contabili_senza_importi', h, total FROM f UNION ALL SELECT 'testi_duplicati', i, total FROM f
 UNION ALL SELECT 'metadati_senza_tipologia', a, total FROM m UNION ALL SELECT 'metadati_dettaglio_duplicato', b, total FROM m)
SELECT issue, count, total, CASE WHEN total = 0 THEN 0.0 ELSE round(CAST(count AS DOUBLE) / total * 100, 2) END AS percent,
 CASE WHEN count = 0 THEN 4 WHEN count / total >= 0.25 THEN 1 WHEN count / total >= 0.10 THEN 2 ELSE 3 END AS priority FROM r"""
)
def quality_scorecard(spark: SparkSession, d: str) -> DataFrame:
    return quality.scorecard(table(spark, d, "allegati_parsed"), table(spark, d, "albo_metadati")).drop("recommendation")


@query(
    """
SELECT count(*) AS rows, count(*) FILTER (coalesce(doc_type, 'unknown') = 'unknown') AS unknown, count(*) FILTER (text_path IS NULL) AS no_path,
 round(CAST(count(*) FILTER (coalesce(doc_type, 'unknown') = 'unknown') AS DOUBLE) / count(*) * 100, 2) AS unknown_percent, count(*) - (SELECT count(*) FROM (SELECT DISTINCT pdf_name FROM allegati_parsed)) AS duplicate_keys,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT text_sha256 FROM allegati_parsed)) AS duplicate_texts FROM allegati_parsed"""
)
def validation_gate(spark: SparkSession, d: str) -> DataFrame:
    return quality.gate_counts(table(spark, d, "allegati_parsed"))


@query("SELECT round(avg(coalesce(text_words, 0)), 1) AS mean_words, CAST(median(coalesce(text_words, 0)) AS DOUBLE) AS median_words FROM allegati_parsed")
def global_words(spark: SparkSession, d: str) -> DataFrame:
    w = F.coalesce("text_words", F.lit(0))
    return table(spark, d, "allegati_parsed").agg(F.round(F.avg(w), 1).alias("mean_words"), F.median(w).alias("median_words"))


@query("SELECT estr_id, text_words FROM allegati_parsed ORDER BY text_words ASC NULLS LAST, estr_id LIMIT 50")
def short_documents(spark: SparkSession, d: str) -> DataFrame:
    return quality.extremes(table(spark, d, "allegati_parsed").select("estr_id", "text_words"), "text_words", "estr_id", largest=False)


@query("SELECT estr_id, text_words FROM allegati_parsed ORDER BY text_words DESC NULLS LAST, estr_id LIMIT 50")
def long_documents(spark: SparkSession, d: str) -> DataFrame:
    return quality.extremes(table(spark, d, "allegati_parsed").select("estr_id", "text_words"), "text_words", "estr_id")


@query("SELECT estr_id, importo_max FROM allegati_parsed WHERE importo_max IS NOT NULL ORDER BY importo_max DESC, estr_id LIMIT 50")
def top_amounts(spark: SparkSession, d: str) -> DataFrame:
    return quality.extremes(table(spark, d, "allegati_parsed").select("estr_id", "importo_max"), "importo_max", "estr_id", drop_null=True)


@query("SELECT estr_id, pdf_name FROM allegati_parsed WHERE classification_confidence = 'ambiguous' ORDER BY estr_id LIMIT 200")
def ambiguous_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "allegati_parsed").filter("classification_confidence = 'ambiguous'").select("estr_id", "pdf_name").orderBy("estr_id").limit(200)


@query("SELECT estr_id, pdf_name FROM allegati_parsed WHERE category IS NULL ORDER BY estr_id LIMIT 200")
def uncategorized_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "allegati_parsed").filter("category is null").select("estr_id", "pdf_name").orderBy("estr_id").limit(200)


@query("SELECT estr_id, pdf_name, category, classification_terms, text_path FROM allegati_parsed WHERE classification_confidence = 'ml_predicted'")
def ml_review(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "allegati_parsed").filter("classification_confidence = 'ml_predicted'").select("estr_id", "pdf_name", "category", "classification_terms", "text_path")


# Amounts and roll-ups


@query("SELECT beneficiario, CAST(coalesce(sum(CAST(importo_max AS DECIMAL(28,2))), 0) AS DOUBLE) AS importo_totale FROM allegati_parsed WHERE beneficiario IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def supplier_ranking(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed").filter("beneficiario is not null")
    return rows.groupBy("beneficiario").agg(quality.money_sum("importo_max").alias("importo_totale")).orderBy(F.desc("importo_totale"), "beneficiario").limit(50)


for _name, _column in (("kpi_by_source", "source"), ("kpi_by_visa", "is_visto_contabile"), ("kpi_by_kind", "doc_type")):

    def _kpi(spark: SparkSession, d: str, column: str = _column) -> DataFrame:
        return table(spark, d, "allegati_parsed").groupBy(column).agg(F.count("importo_max").alias("count"), quality.money_sum("importo_max").alias("sum"))

    _kpi.__name__ = _name
    query(f"SELECT {_column}, count(importo_max) AS count, CAST(coalesce(sum(CAST(importo_max AS DECIMAL(28,2))), 0) AS DOUBLE) AS sum FROM allegati_parsed GROUP BY 1")(_kpi)


@query("SELECT count(*) AS documents, count(cig) AS with_cig, count(importo_max) AS with_amount, count(beneficiario) AS with_beneficiary FROM allegati_parsed")
def filled_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "allegati_parsed").agg(F.count("*").alias("documents"), F.count("cig").alias("with_cig"), F.count("importo_max").alias("with_amount"), F.count("beneficiario").alias("with_beneficiary"))


@query(
    f"""
WITH r AS (SELECT estr_id, unnest(importi_raw) AS raw, generate_subscripts(importi_raw, 1) AS place FROM allegati_parsed),
s AS (SELECT estr_id, place, raw, replace(replace(replace(trim(raw), ' ', ''), '''', ''), '€', '') AS s FROM r), n AS (SELECT *, {CLEANED_AMOUNT} AS n FROM s)
SELECT estr_id, CAST(place AS BIGINT) AS place, {AMOUNT.format("n")} AS amount FROM n"""
)
def amount_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed").select("estr_id", F.posexplode("importi_raw").alias("at", "raw"))
    return rows.select("estr_id", (F.col("at") + 1).cast("bigint").alias("place"), money.amount(F.replace("raw", F.lit("€"), F.lit(""))).alias("amount"))


@query(
    rf"""
WITH t AS (SELECT doc_key, coalesce(text, '') AS t FROM documenti_corpus),
r AS (SELECT doc_key, unnest(list_concat(list_concat(regexp_extract_all(t, '€\s*([0-9.,]+)', 1), regexp_extract_all(t, '(?:importo|totale|spesa complessiva|impegno di spesa|per\s+un\s+importo\s+di)\s+€?\s*([0-9.,]+)', 1)),
 regexp_extract_all(t, 'euro\s*([0-9.,]+)', 1))) AS s FROM t), n AS (SELECT doc_key, {CLEANED_AMOUNT} AS n FROM r), a AS (SELECT doc_key, {AMOUNT.format("n")} AS a FROM n)
SELECT t.doc_key, max(a) AS importo_max, CAST(sum(CAST(a AS DECIMAL(28,2))) AS DOUBLE) AS importo_sum, count(a) AS importi_count FROM t LEFT JOIN a USING (doc_key) GROUP BY 1"""
)
def amounts_of_texts(spark: SparkSession, d: str) -> DataFrame:
    found = extract.amount_fields("text")
    return table(spark, d, "documenti_corpus").select("doc_key", *(v.alias(k) for k, v in found.items()))


# Kinds, categories, fields


def _rules_sql(rules: list, column: str) -> str:
    return " ".join(f"WHEN regexp_matches(lower({column}), '{'|'.join(w.replace('.', chr(92) + '.') for w in words)}') THEN '{label}'" for label, words in rules)


@query(f"SELECT doc_key, CASE {_rules_sql(classify.NAME_RULES, 'coalesce(pdf_name, chr(32))')} {_rules_sql(classify.HEAD_RULES, 'substring(coalesce(text, chr(32)), 1, 2500)')} ELSE 'unknown' END AS doc_type FROM documenti_corpus")
def document_kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documenti_corpus").select("doc_key", classify.document_kind("pdf_name", "text").alias("doc_type"))


def _hit(text_: str, word: str) -> str:
    return rf"regexp_matches({text_}, '(?i)(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])')"


_SCORES = " UNION ALL ".join(
    f"SELECT doc_key, '{c}' AS category, {' + '.join(f'4 * CAST({_hit(chr(111), w)} AS INT) + CAST({_hit(chr(104), w)} AS INT)' for w in ws)} AS score FROM b" for c, ws in classify.CATEGORIES.items()
)
_SUBS = " ".join(f"WHEN {' OR '.join(_hit('both_', w) for w in ws)} THEN '{c}'" for c, ws in classify.SUBCATEGORIES.items())


@query(
    f"""
WITH b AS (SELECT doc_key, coalesce(oggetto, '') AS o, substring(coalesce(text, ''), 1, 3500) AS h, coalesce(oggetto, '') || ' ' || coalesce(text, '') AS both_ FROM documenti_corpus),
s AS (SELECT * FROM ({_SCORES}) WHERE score > 0), r AS (SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY score DESC, category) AS n, lead(score) OVER (PARTITION BY doc_key ORDER BY score DESC, category) AS nx FROM s)
SELECT b.doc_key, r.category, CASE WHEN r.category IS NULL THEN NULL WHEN r.nx = r.score THEN 'ambiguous' ELSE 'high' END AS classification_confidence, CASE {_SUBS} END AS subcategory
FROM b LEFT JOIN r ON b.doc_key = r.doc_key AND r.n = 1"""
)
def keyword_classes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documenti_corpus").select("doc_key", "oggetto", "text")
    return classify.classified(docs).select("doc_key", "category", "classification_confidence", "subcategory")


@query(
    "SELECT doc_key, CASE WHEN coalesce(doc_type, '') IN ('Ordinanza', 'Decreto', 'Elenco', 'AttestazionePubblicazione') THEN false WHEN doc_type = 'VistoContabile' THEN true WHEN regexp_matches(lower(coalesce(text, '')), '"
    + "|".join(classify.MONEY_WORDS)
    + "') THEN true WHEN coalesce(category, '') = 'Contabilità' AND doc_type = 'Determinazione' THEN true WHEN doc_type = 'Determinazione' AND regexp_matches(lower(coalesce(text, '')), 'servizio|lavori|fornitura') THEN true ELSE false END AS about_money FROM documenti_corpus"
)
def accounting_relevance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documenti_corpus").select("doc_key", classify.about_money("text", "doc_type", "category").alias("about_money"))


@query(
    rf"""
WITH t AS (SELECT doc_key, {NORM.format("text")} AS t FROM documenti_corpus)
SELECT doc_key, upper(nullif(regexp_extract(t, '(?i)\bC\.?I\.?G\.?[\s:\-]*([A-Z0-9]{{10}})\b', 1), '')) AS cig, upper(nullif(regexp_extract(t, '(?i)\bC\.?U\.?P\.?[\s:\-]*([A-Z0-9]{{15}})\b', 1), '')) AS cup,
 nullif(regexp_extract(t, '(?i)N\.\s*(\d+)\s*DEL\s*(\d{{2}}/\d{{2}}/\d{{4}})', 1), '') AS numero_atto, nullif(regexp_extract(t, '(?i)N\.\s*(\d+)\s*DEL\s*(\d{{2}}/\d{{2}}/\d{{4}})', 2), '') AS data_atto,
 nullif(regexp_extract(t, '(?i)(?:capitolo|Capitolo\s+Quinti\s+Livello)\s*[:\s]*([\d.]+)', 1), '') AS capitolo, nullif(regexp_extract(t, '(?i)(?:impegno|impegno\s+n\.|N\.\s+Impegno\s+Definitivo)\s*[:\s]*(\d+)', 1), '') AS impegno_num FROM t"""
)
def act_fields(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documenti_corpus").select("doc_key", text.normalized("text").alias("t"))
    found = extract.act_fields("t")
    return docs.select("doc_key", *(found[k].alias(k) for k in ("cig", "cup", "numero_atto", "data_atto", "capitolo", "impegno_num")))


def _record_sql(strict: bool = False) -> str:
    """The whole record. RE2 has no lookahead; a group that is not captured gives the same first group."""
    re2 = lambda p: p.replace("(?iu)", "(?i)").replace("(?=", "(?:").replace("'", "''")
    hit = lambda p, k=1: f"nullif(regexp_extract(t, '{re2(p)}', {k}), '')"
    short = lambda x: rf"trim(regexp_replace(trim({x}, ' :;-|'), '(?i)\s*-\s*Progressivo Fornitore.*', '', 'g'))"
    untrimmed = lambda x: rf"regexp_replace(trim({x}, ' :;-|'), '(?i)\s*-\s*Progressivo Fornitore.*', '', 'g')"
    payee = lambda x, most: f"CASE WHEN length({untrimmed(x)}) < {most} THEN nullif({short(x)}, '') END"
    f = {n: f"nullif(trim({hit(extract.PATTERNS[extract.GROUPS.get(n, (n, 1))[0]], extract.GROUPS.get(n, (n, 1))[1])}), '')" for n in extract.FIELDS}
    f["oggetto"] = f"CASE WHEN length({f['oggetto']}) > 1500 THEN substring({f['oggetto']}, 1, 1500) || '...' ELSE {f['oggetto']} END"
    f["beneficiario"] = payee(f["beneficiario"], 150)
    more = ""
    if strict:
        kind = "CASE " + " ".join(f"WHEN regexp_matches(t, '{re2(p)}') THEN '{n}'" for n, p in extract.OTHER_ACTS.items()) + " ELSE 'transactional' END"
        paying = lambda x: f"CASE WHEN {kind} = 'transactional' THEN {x} END"
        f["cig"], f["cup"] = paying(hit(extract.STRICT_CIG)), paying(hit(extract.STRICT_CUP))
        f["beneficiario"] = paying("coalesce(" + ", ".join(payee(hit(p), extract.STRICT_NAME) for p in extract.PAID) + ")")
        f["act_class"] = kind
        more = f", regexp_extract_all(t, '{extract.TABLE_AMOUNT}', 1)"
    f["cig"], f["cup"] = f"upper({f['cig']})", f"upper({f['cup']})"
    found = r"regexp_extract_all(t, '€\s*([0-9.,]+)', 1), regexp_extract_all(t, '(?:importo|totale|spesa complessiva|impegno di spesa|per\s+un\s+importo\s+di)\s+€?\s*([0-9.,]+)', 1), regexp_extract_all(t, 'euro\s*([0-9.,]+)', 1)"
    return f"""
WITH n AS (SELECT doc_key, pdf_name, {NORM.format("text")} AS t FROM documenti_corpus), w AS (SELECT *, {WORDS.format("t")} AS ws FROM n),
r AS (SELECT doc_key, unnest(flatten([{found}{more}])) AS s FROM n), k AS (SELECT doc_key, {CLEANED_AMOUNT} AS n FROM r), v AS (SELECT doc_key, {AMOUNT.format("n")} AS a FROM k),
a AS (SELECT doc_key, max(a) AS importo_max, CAST(sum(CAST(a AS DECIMAL(28,2))) AS DOUBLE) AS importo_sum, count(a) AS importi_count FROM v GROUP BY 1)
SELECT w.doc_key, pdf_name, {", ".join(f"{x} AS {n}" for n, x in f.items())}, CAST(NULL AS VARCHAR) AS impegno_anno, CAST(NULL AS VARCHAR) AS accert_anno, importo_max, importo_sum, coalesce(importi_count, 0) AS importi_count, {_FEATURES},
 contains(coalesce(pdf_name, ''), 'VistoContabile') AS is_visto_contabile, sha256(t) AS text_sha256, substring(t, 1, 1200) AS text_preview FROM w LEFT JOIN a USING (doc_key)"""


@query(_record_sql())
def extraction(spark: SparkSession, d: str) -> DataFrame:
    """The whole record of every document."""
    return extract.extracted(table(spark, d, "documenti_corpus").select("doc_key", "pdf_name", "text")).drop("text")


@query(_record_sql(strict=True))
def extraction_strict(spark: SparkSession, d: str) -> DataFrame:
    return extract.extracted(table(spark, d, "documenti_corpus").select("doc_key", "pdf_name", "text"), strict=True).drop("text")


# Notices: dates, filters, addresses, keys

_DATE = "coalesce(CASE WHEN regexp_full_match(s, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') THEN try_strptime(s, '%d/%m/%Y') END, CASE WHEN regexp_full_match(s, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN try_strptime(s, '%Y-%m-%d') END, CASE WHEN regexp_full_match(s, '[0-9]{4}') THEN try_strptime(s, '%Y') END)"
_NOTICE = "(SELECT *, trim(data_pubblicazione) AS s FROM albo_metadati)"


@query(f"SELECT atto_id, CAST({_DATE} AS DATE) AS data FROM {_NOTICE}")
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "albo_metadati").select("atto_id", dates.parse_date("data_pubblicazione").alias("data"))


@query(
    rf"""SELECT atto_id FROM {_NOTICE} WHERE coalesce(lower(tipologia), '') <> 'avviso' AND CAST({_DATE} AS DATE) BETWEEN DATE '2023-06-01' AND DATE '2025-06-30'
 AND regexp_matches(coalesce(titolo, '') || ' ' || coalesce(oggetto, ''), '(?i)servizio|lavori|contributo')"""
)
def notice_filter(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat(F.coalesce("titolo", F.lit("")), F.lit(" "), F.coalesce("oggetto", F.lit("")))
    kind = F.coalesce(F.lower("tipologia"), F.lit("")) != "avviso"
    return table(spark, d, "albo_metadati").filter(kind & dates.within("data_pubblicazione", "2023-06-01", "2025-06-30") & title.rlike("(?i)servizio|lavori|contributo")).select("atto_id")


@query(
    r"""
WITH t AS (SELECT atto_id, coalesce(nullif(trim(tipologia), ''), CASE WHEN regexp_matches(lower(x), 'determina') THEN 'Determinazione' WHEN regexp_matches(lower(x), 'delibera') THEN 'Delibera' WHEN regexp_matches(lower(x), 'ordinanza') THEN 'Ordinanza'
  WHEN regexp_matches(lower(x), 'avviso') THEN 'Avviso' WHEN regexp_matches(lower(x), 'bando') THEN 'Bando' END) AS tipologia,
 CASE WHEN lower(trim(coalesce(titolo, ''))) IN ('', 'vai') THEN substring(coalesce(oggetto, ''), 1, 180) ELSE titolo END AS titolo FROM (SELECT *, coalesce(titolo, '') || ' ' || coalesce(oggetto, '') AS x FROM albo_metadati))
SELECT * FROM t"""
)
def enriched_notices(spark: SparkSession, d: str) -> DataFrame:
    return classify.enriched(table(spark, d, "albo_metadati")).select("atto_id", "tipologia", "titolo")


@query(
    r"""
SELECT atto_id, coalesce(nullif(regexp_extract(t, '(?i)\b(?:n\.|numero|copia|originale)[_\s-]*([0-9]{1,6})\b', 1), ''), nullif(regexp_extract(t, '_([0-9]{1,6})_20[0-9]{2}\b', 1), ''), nullif(regexp_extract(t, '\b([0-9]{1,6})/20[0-9]{2}\b', 1), '')) AS numero,
 coalesce(nullif(regexp_extract(t, '\b([0-9]{2}/[0-9]{2}/[0-9]{4}|20[0-9]{2}-[0-9]{2}-[0-9]{2})\b', 1), ''), nullif(regexp_extract(t, '\b(20[0-9]{2})\b', 1), '')) AS data FROM (SELECT atto_id, coalesce(titolo, '') || ' ' || coalesce(oggetto, '') AS t FROM albo_metadati)"""
)
def inferred_number_date(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.coalesce("titolo", F.lit("")), F.lit(" "), F.coalesce("oggetto", F.lit("")))
    return table(spark, d, "albo_metadati").select("atto_id", dates.infer_number(t).alias("numero"), dates.infer_date(t).alias("data"))


@query(
    r"""
SELECT atto_id, regexp_replace(dettaglio_url, '^.*[?&]id=([0-9]+).*$', '\1') AS id, regexp_replace(page_url, '([?&]pagina=)[0-9]+', '\1' || CAST(CAST(regexp_extract(page_url, '[?&]pagina=([0-9]+)', 1) AS BIGINT) + 1 AS VARCHAR)) AS next_url
FROM albo_metadati WHERE regexp_matches(page_url, '[?&]pagina=[0-9]+') AND regexp_matches(dettaglio_url, '[?&]id=[0-9]+')"""
)
def next_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "albo_metadati").filter(F.col("page_url").rlike("[?&]pagina=[0-9]+") & F.col("dettaglio_url").rlike("[?&]id=[0-9]+"))
    return rows.select("atto_id", urls.query_value("dettaglio_url", "id").alias("id"), urls.next_page("page_url").alias("next_url"))


@query(
    r"""
SELECT atto_id, nullif(regexp_extract(dettaglio_url, '[?&]id=([^&#]*)', 1), '') AS id,
 CASE WHEN n <> '' THEN regexp_replace(page_url, '([?&]pagina=)[^&#]*', '\1' || CAST(coalesce(try_cast(n AS BIGINT), 1) + 1 AS VARCHAR), 'g') ELSE page_url || CASE WHEN contains(page_url, '?') THEN '&' ELSE '?' END || 'pagina=2' END AS next_url
FROM (SELECT *, regexp_extract(coalesce(page_url, ''), '[?&]pagina=([^&#]*)', 1) AS n FROM albo_metadati)"""
)
def next_pages_all(spark: SparkSession, d: str) -> DataFrame:
    """The following page of every notice's page, page 2 where none is named; without an address there is none."""
    return table(spark, d, "albo_metadati").select("atto_id", urls.query_value("dettaglio_url", "id").alias("id"), urls.next_page("page_url").alias("next_url"))


@query()
def attachment_names(spark: SparkSession, d: str) -> DataFrame:
    """Name, ending and kind of link of every attachment."""
    rows = split_packed(table(spark, d, "albo_metadati"), "allegati", "atto_id", value="url")
    return rows.select("atto_id", "posizione", urls.document_name("url").alias("name"), urls.extension("url").alias("ending"), urls.is_attachment("url").alias("is_attachment"), text.cache_key("url").alias("cache_key"))


_LISTED = "CASE WHEN s = '' THEN [] WHEN s LIKE '[\"%' THEN from_json(s, '[\"VARCHAR\"]') WHEN s LIKE '%;%' THEN list_filter(list_transform(string_split(s, ';'), lambda x: trim(x)), lambda x: x <> '') WHEN s LIKE '%|%' THEN list_filter(list_transform(string_split(s, '|'), lambda x: trim(x)), lambda x: x <> '') ELSE [s] END"


@query(f"SELECT atto_id, unnest({_LISTED}) AS allegato FROM (SELECT atto_id, trim(coalesce(allegati, '')) AS s FROM albo_metadati) WHERE s NOT LIKE '[''%' AND (s NOT LIKE '[%' OR s LIKE '[\"%\"]')")
def listed_attachments(spark: SparkSession, d: str) -> DataFrame:
    """The simple reading of list fields: JSON lists, `;` and `|`. Only the fields that its SQL can read; listed_attachments_all has every notice."""
    s = F.trim(F.coalesce("allegati", F.lit("")))
    rows = table(spark, d, "albo_metadati").filter(~s.startswith("['") & (~s.startswith("[") | (s.startswith('["') & s.endswith('"]'))))
    return rows.select("atto_id", F.explode(arrays.listed("allegati")).alias("allegato"))


@query()
def listed_attachments_all(spark: SparkSession, d: str) -> DataFrame:
    """The simple reading of the list field of every notice, lists in Python's form and lists that never close too."""
    return table(spark, d, "albo_metadati").select("atto_id", F.explode(arrays.listed("allegati")).alias("allegato"))


@query()
def notice_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "albo_metadati")
    return rows.select("atto_id", arrays.notice_key("dettaglio_url", arrays.listed("allegati"), "titolo", "numero", "data_pubblicazione", "oggetto").alias("key"))


@query("SELECT atto_id, titolo FROM (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY atto_id) AS n FROM albo_metadati) WHERE n <= 3")
def first_notices_of_pages(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("page_url").orderBy("atto_id")  # Spark keeps three rows a page in each task before the shuffle
    return table(spark, d, "albo_metadati").withColumn("_n", F.row_number().over(w)).filter("_n <= 3").select("atto_id", "titolo")


# Joins against what is known


@query("SELECT dettaglio_url, min(atto_id) AS atto_id FROM albo_metadati WHERE dettaglio_url IS NOT NULL AND raccolto_il >= TIMESTAMP '2025-01-01' AND dettaglio_url NOT IN (SELECT dettaglio_url FROM albo_metadati WHERE dettaglio_url IS NOT NULL AND raccolto_il < TIMESTAMP '2025-01-01') GROUP BY 1")
def new_notices(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "albo_metadati").select("dettaglio_url", "atto_id", "raccolto_il")
    old, new = rows.filter("raccolto_il < timestamp_ntz'2025-01-01'"), rows.filter("raccolto_il >= timestamp_ntz'2025-01-01'")
    return incremental.unseen(new, incremental.seen_keys(old, "dettaglio_url"), "dettaglio_url", "atto_id").select("dettaglio_url", "atto_id")


@query("SELECT DISTINCT seen FROM (SELECT dettaglio_url AS seen FROM albo_metadati UNION ALL SELECT page_url FROM albo_metadati) WHERE seen IS NOT NULL AND seen <> ''")
def seen_set(spark: SparkSession, d: str) -> DataFrame:
    return incremental.seen_keys(table(spark, d, "albo_metadati"), "dettaglio_url", "page_url")


@query("SELECT estr_id, pdf_name FROM allegati_parsed WHERE pdf_name NOT IN (SELECT pdf_name FROM documenti_corpus WHERE pdf_name IS NOT NULL)")
def unprocessed_documents(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed").select("estr_id", "pdf_name").filter("pdf_name is not null")
    return incremental.split_processed(rows, table(spark, d, "documenti_corpus"), "pdf_name")[1]


@query("SELECT estr_id, pdf_name FROM allegati_parsed WHERE pdf_name IN (SELECT pdf_name FROM documenti_corpus)")
def reused_documents(spark: SparkSession, d: str) -> DataFrame:
    return incremental.split_processed(table(spark, d, "allegati_parsed").select("estr_id", "pdf_name"), table(spark, d, "documenti_corpus"), "pdf_name")[0]


@query("SELECT pdf_name, category, reason FROM (SELECT pdf_name, category, CAST(NULL AS VARCHAR) AS reason FROM allegati_parsed UNION ALL SELECT pdf_name, NULL, reason FROM failed_extractions)")
def with_failures(spark: SparkSession, d: str) -> DataFrame:
    return incremental.with_failures(table(spark, d, "allegati_parsed").select("pdf_name", "category"), table(spark, d, "failed_extractions").select("pdf_name", "reason"))


@query("SELECT c.doc_key, a.estr_id, c.category, a.category AS category_allegati FROM documenti_corpus c JOIN allegati_parsed a USING (pdf_name)")
def features_with_attachments(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "documenti_corpus").select("doc_key", "pdf_name", "category")
    return incremental.suffixed_join(left, table(spark, d, "allegati_parsed").select("estr_id", "pdf_name", "category"), "pdf_name", "_allegati").drop("pdf_name")


@query("SELECT c.doc_key, CASE WHEN a.pdf_name IS NOT NULL THEN a.category ELSE c.category END AS category FROM documenti_corpus c LEFT JOIN (SELECT pdf_name, arg_max(coalesce(category, 'nessuna'), estr_id) AS category FROM allegati_parsed GROUP BY 1) a USING (pdf_name)")
def updated_categories(spark: SparkSession, d: str) -> DataFrame:
    changes = table(spark, d, "allegati_parsed").filter("pdf_name is not null").select("pdf_name", "estr_id", F.coalesce("category", F.lit("nessuna")).alias("category"))
    return incremental.updated(table(spark, d, "documenti_corpus").select("doc_key", "pdf_name", "category"), changes, "pdf_name", "estr_id", ["category"]).drop("pdf_name")


@query("SELECT a.estr_id, coalesce(c.text, '') AS text FROM allegati_parsed a LEFT JOIN (SELECT pdf_name, min(text) AS text FROM documenti_corpus GROUP BY 1) c USING (pdf_name)")
def records_with_text(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documenti_corpus").groupBy("pdf_name").agg(F.min("text").alias("text"))
    return incremental.with_text(table(spark, d, "allegati_parsed").select("estr_id", "pdf_name"), texts, "pdf_name").select("estr_id", "text")


# Search


@query(
    """
WITH s AS (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 1 - 300, 0), 2700)) AS s FROM documents WHERE length(text) >= 50)
SELECT doc_id, CAST(s // 2700 AS BIGINT) AS chunk_no, substring(text, s + 1, 3000) AS chunk FROM s"""
)
def chunk_fixed(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.fixed_chunks(table(spark, d, "documents"), "doc_id")


@query(
    """
WITH k AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE pubblicato_il < TIMESTAMP '2025-01-01' AND text IS NOT NULL),
s AS (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 1 - 300, 0), 2700)) AS s FROM documents WHERE length(text) >= 50 AND sha256(text) NOT IN (SELECT h FROM k))
SELECT doc_id, CAST(s // 2700 AS BIGINT) AS chunk_no, substring(text, s + 1, 3000) AS chunk FROM s"""
)
def chunks_to_index(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the texts that an index of the older documents does not have yet, told by the hash of the text."""
    docs = table(spark, d, "documents").select("doc_id", "text", "pubblicato_il", F.sha2("text", 256).alias("fingerprint"))
    known = docs.filter("pubblicato_il < timestamp_ntz'2025-01-01' and text is not null").select("fingerprint")
    new = docs.select("doc_id", "text", "fingerprint").join(known, "fingerprint", "left_anti")
    return retrieval.fixed_chunks(new, "doc_id")


@query()
def chunk_recursive(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.recursive_chunks(table(spark, d, "documents"), "doc_id")


@query(
    """
WITH h AS (SELECT doc_key, substring(coalesce(text, ''), 1, 3000) AS c, array_to_string(list_filter([CASE WHEN trim(coalesce(oggetto, '')) <> '' THEN 'Oggetto: ' || substring(oggetto, 1, 250) END, CASE WHEN trim(coalesce(cig, '')) <> '' THEN 'CIG: ' || cig END,
 CASE WHEN trim(coalesce(cup, '')) <> '' THEN 'CUP: ' || cup END], lambda x: x IS NOT NULL), '. ') AS p FROM documenti_corpus)
SELECT doc_key, CASE WHEN p = '' THEN c ELSE p || '.' || chr(10) || chr(10) || c END AS chunk FROM h"""
)
def chunk_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The first chunk only, as its SQL; chunk_prefix_all has every chunk."""
    first = F.substring(F.coalesce("text", F.lit("")), 1, retrieval.SIZE)  # the first chunk of the act
    return table(spark, d, "documenti_corpus").select("doc_key", retrieval.prefixed(F.col("oggetto"), F.col("cig"), F.col("cup"), first).alias("chunk"))


@query()
def chunk_prefix_all(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk of every act, each with the act's subject and codes before it."""
    return retrieval.prefixed_chunks(table(spark, d, "documenti_corpus"), "doc_key")


_SEARCH = f"""
WITH q AS (SELECT atto_id AS question_id, unnest({TOKENS.format("oggetto")}) AS token FROM albo_metadati WHERE atto_id % 20 = 0), t AS (SELECT doc_key, unnest({TOKENS.format("text")}) AS token FROM documenti_corpus),
h AS (SELECT question_id, doc_key, count(*) AS overlap FROM q JOIN t USING (token) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY overlap DESC, doc_key) AS rank FROM h)"""


def _found(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "albo_metadati").filter("atto_id % 20 = 0").select(F.col("atto_id").alias("question_id"), "oggetto")  # the stated set of questions
    return retrieval.overlap_search(asked, "oggetto", table(spark, d, "documenti_corpus"), "doc_key")


@query(_SEARCH + " SELECT question_id, doc_key, overlap, rank FROM r WHERE rank <= 6")
def overlap_search(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)


@query(
    _SEARCH
    + """ SELECT question_id, 'Rispondi solo in base al contesto.' || chr(10) || chr(10) || 'Contesto:' || chr(10) || string_agg(coalesce(c.oggetto, ''), chr(10) || chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Domanda: ' || any_value(m.oggetto) || chr(10) || 'Risposta:' AS prompt
FROM r JOIN documenti_corpus c USING (doc_key) JOIN albo_metadati m ON m.atto_id = r.question_id WHERE rank <= 6 GROUP BY question_id"""
)
def prompts(spark: SparkSession, d: str) -> DataFrame:
    hits = _found(spark, d).join(table(spark, d, "documenti_corpus").select("doc_key", F.coalesce("oggetto", F.lit("")).alias("passage")), "doc_key")
    hits = hits.join(table(spark, d, "albo_metadati").select(F.col("atto_id").alias("question_id"), F.col("oggetto").alias("question")), "question_id")
    return retrieval.prompts(hits, "question_id", "question", "passage")


def _vector_sql(distance: str) -> str:
    return f"""
WITH p AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
d AS (SELECT query_id, vec_id, round({distance}, 4) AS distance FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) SELECT * FROM r WHERE rank <= 6"""


@query(_vector_sql("list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"))
def vector_search_l2(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.vector_search(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query(_vector_sql("1 - list_cosine_similarity(x, y)"))
def vector_search_cosine(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.vector_search(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, cosine=True)


# Measures

_TAGS = "coalesce(array_to_string(list_sort(list_transform(map_entries(tags), lambda e: e.key || '=' || coalesce(e.value, ''))), ','), '')"


@query(
    f"""SELECT point_id, metric_name, tags_key, CAST(sum(CAST(coalesce(metric_value, 0) AS DECIMAL(28,4))) OVER (PARTITION BY metric_name, tags_key ORDER BY recorded_at NULLS FIRST, point_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
FROM (SELECT *, {_TAGS} AS tags_key FROM metric_points)"""
)
def running_counters(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "metric_points").select("point_id", "metric_name", "recorded_at", "metric_value", measures.tags_key("tags").alias("tags_key"))
    return measures.running(points, ["metric_name", "tags_key"], ["recorded_at", "point_id"], "metric_value").drop("recorded_at", "metric_value")


@query(f"SELECT metric_name, tags_key, value FROM (SELECT metric_name, {_TAGS} AS tags_key, metric_value AS value, row_number() OVER (PARTITION BY metric_name, {_TAGS} ORDER BY recorded_at DESC NULLS LAST, point_id DESC) AS n FROM metric_points WHERE metric_value IS NOT NULL) WHERE n = 1")
def last_gauges(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "metric_points").filter("metric_value is not null").withColumn("tags_key", measures.tags_key("tags"))
    return measures.gauges(points, ["metric_name", "tags_key"], ["recorded_at", "point_id"], "metric_value")


@query(
    """SELECT event_type, count(*) AS count, CAST(sum(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS total, count(*) FILTER (value >= 10) AS successes, count(*) - count(*) FILTER (value >= 10) AS failures,
 round(CAST(count(*) FILTER (value >= 10) AS DOUBLE) / count(*), 6) AS success_rate FROM events GROUP BY 1"""
)
def operation_summary(spark: SparkSession, d: str) -> DataFrame:
    return measures.operations(table(spark, d, "events"), "event_type", "value", F.col("value") >= 10).drop("average")


@query("SELECT point_id, metric_name FROM metric_points ORDER BY recorded_at DESC NULLS LAST, point_id DESC LIMIT 1000")
def recent_points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metric_points").orderBy(F.desc_nulls_last("recorded_at"), F.desc("point_id")).limit(1000).select("point_id", "metric_name")


@query("SELECT count(*) FILTER (metric_value >= 1) AS hits, count(*) - count(*) FILTER (metric_value >= 1) AS misses, round(CAST(count(*) FILTER (metric_value >= 1) AS DOUBLE) / count(*), 6) AS hit_rate FROM metric_points WHERE metric_name = 'cache_hits'")
def cache_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    return measures.hit_rate(table(spark, d, "metric_points").filter("metric_name = 'cache_hits'"), F.col("metric_value") >= 1)


@query("WITH l AS (SELECT user_id, max(ts) AS last_used FROM events GROUP BY 1) SELECT user_id, last_used FROM l WHERE user_id NOT IN (SELECT user_id FROM l ORDER BY last_used DESC, user_id LIMIT 20)")
def evicted_keys(spark: SparkSession, d: str) -> DataFrame:
    return measures.least_recently_used(table(spark, d, "events"), "user_id", "ts", 20)


@query("SELECT user_id, max(ts) AS last_used FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-29'")
def expired_keys(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_used"))
    return last.join(incremental.unexpired(last, F.expr("timestamp_ntz'2024-01-29'"), "last_used").select("user_id"), "user_id", "left_anti")


# Labels


@query("SELECT estr_id, category, CAST(('0x' || substring(md5(CAST(estr_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 < 800 AS train FROM allegati_parsed WHERE category IS NOT NULL AND classification_confidence = 'high'")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed").filter("category is not null and classification_confidence = 'high'").select("estr_id", "category")
    return ml.split_stratified(rows, "category", "estr_id")


@query("WITH n AS (SELECT category, count(*) AS n FROM allegati_parsed WHERE category IS NOT NULL GROUP BY 1) SELECT category, (SELECT max(n) FROM n) AS rows, n AS different FROM n")
def oversampled_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed").filter("category is not null").select("estr_id", "category")
    return ml.oversampled(rows, "category", "estr_id").groupBy("category").agg(F.count("*").alias("rows"), F.countDistinct("estr_id").alias("different"))


_GUESS = "SELECT a.category AS truth, c.category AS guess FROM allegati_parsed a JOIN documenti_corpus c USING (pdf_name) WHERE a.category IS NOT NULL AND c.category IS NOT NULL"


@query(
    f"""
WITH g AS ({_GUESS}), l AS (SELECT truth AS label FROM g UNION SELECT guess FROM g), s AS (SELECT label, (SELECT count(*) FROM g WHERE truth = label AND guess = label) AS tp, (SELECT count(*) FROM g WHERE truth = label) AS support, (SELECT count(*) FROM g WHERE guess = label) AS named FROM l)
SELECT label, CASE WHEN named = 0 THEN 0.0 ELSE round(tp / named, 6) END AS precision, CASE WHEN support = 0 THEN 0.0 ELSE round(tp / support, 6) END AS recall, round(2 * tp / (named + support), 6) AS f1, support FROM s"""
)
def label_report(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "allegati_parsed").select("pdf_name", F.col("category").alias("truth")).join(table(spark, d, "documenti_corpus").select("pdf_name", F.col("category").alias("guess")), "pdf_name")
    return ml.class_report(pairs, "truth", "guess")


@query("SELECT estr_id, CASE WHEN least(text_words / 500, 1) >= 0.5 THEN category ELSE 'Da_Revisionare_Manualmente' END AS final_category FROM allegati_parsed WHERE category IS NOT NULL AND text_words IS NOT NULL")
def threshold_relabel(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "allegati_parsed").filter("category is not null and text_words is not null")
    return rows.select("estr_id", ml.relabelled("category", F.least(F.col("text_words") / 500, F.lit(1.0))).alias("final_category"))


@query(
    """
WITH u AS (SELECT pdf_name FROM allegati_parsed WHERE classification_confidence IN ('ambiguous', 'unknown')),
p AS (SELECT pdf_name, arg_max(category, doc_key) AS category FROM documenti_corpus WHERE pdf_name IN (SELECT pdf_name FROM u WHERE pdf_name IS NOT NULL) AND category IS NOT NULL AND least(text_words / 500, 1) >= 0.5 GROUP BY 1)
SELECT estr_id, CASE WHEN p.pdf_name IS NULL THEN a.category ELSE p.category END AS category, CASE WHEN p.pdf_name IS NULL THEN classification_confidence ELSE 'high_ml' END AS classification_confidence FROM allegati_parsed a LEFT JOIN p ON a.pdf_name = p.pdf_name"""
)
def ml_write_back(spark: SparkSession, d: str) -> DataFrame:
    """Predictions for ambiguous and unknown files put into the table where they are sure enough. The prediction of a file is
    here the category of its text, the longer the surer; that of a model goes the same way."""
    rows = table(spark, d, "allegati_parsed").select("estr_id", "pdf_name", "category", "classification_confidence")
    unsure = rows.filter("classification_confidence in ('ambiguous', 'unknown')").select("pdf_name")
    guess = table(spark, d, "documenti_corpus").join(unsure, "pdf_name", "left_semi").select("pdf_name", "doc_key", "category", F.least(F.col("text_words") / 500, F.lit(1.0)).alias("sure"))
    return ml.written_back(rows, guess, "pdf_name", "doc_key").drop("pdf_name")


@query()
def forest_labels(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a sure category, labelled by a random forest over TF-IDF that is trained on a bounded sample of the sure ones, each label as often."""
    sure = table(spark, d, "allegati_parsed").filter("classification_confidence = 'high'").select("pdf_name").distinct()
    docs = table(spark, d, "documenti_corpus").filter("text is not null").select("doc_key", "pdf_name", "category", text.normalized("text").alias("text"))
    labelled = docs.join(sure, "pdf_name", "left_semi").filter("category is not null")
    train = ml.split_stratified(bounded(labelled, "doc_key"), "category", "doc_key").filter("train").select("doc_key", "text", "category")
    model = ml.fitted_balanced(ml.text_forest("text", "category"), train, "category", "doc_key")
    rest = docs.join(sure, "pdf_name", "left_anti").select("doc_key", "text")
    out = ml.predicted(model, rest, ["doc_key"])
    return out.select("doc_key", "predicted", F.round("predicted_confidence", 6).alias("predicted_confidence"), ml.relabelled("predicted", "predicted_confidence").alias("final_category"))


TRAINING_ROWS = 20_000


def bounded(df: DataFrame, key: str, rows: int = TRAINING_ROWS) -> DataFrame:
    """At most about `rows` labelled rows, by a hash of the key: the documented bound of what a classifier is fitted on."""
    share = min(1.0, rows / max(1, df.count()))
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000))
