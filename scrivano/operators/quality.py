"""Distributions, profiles, the quality scorecard, outliers and the validation gate.

Nulls are groups of their own, sums over nothing are 0, sorts put nulls last and ties are broken by the key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivano.functions.text import percent, priority

EMPTY = "<vuoto>"


def distribution(df: DataFrame, name: str, top: int = 30) -> DataFrame:
    """Most frequent values with their counts; null is `<vuoto>`."""
    values = F.coalesce(F.col(name).cast("string"), F.lit(EMPTY)).alias(name)
    return df.groupBy(values).agg(F.count("*").alias("count")).orderBy(F.desc("count"), name).limit(top)


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts of `rows` by the given values of `columns`; naming the values saves a pass over the data."""
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(EMPTY))
    return df.groupBy(full(rows).alias(rows)).agg(*(F.count_if(full(columns) == v).alias(v) for v in values))


def money_sum(c: str | Column) -> Column:
    """Sum of amounts with two places, exact whatever the order of the rows; 0 of nothing."""
    return F.coalesce(F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(28,2)")), F.lit(0).cast("decimal(28,2)")).cast("double")


def numeric_profile(df: DataFrame, by: str = "category") -> DataFrame:
    return df.groupBy(by).agg(
        F.count("pdf_name").alias("docs"), F.avg("text_words").alias("text_words_mean"), F.median("text_words").alias("text_words_median"), F.count("importo_max").alias("importo_max_count"), money_sum("importo_max").alias("importo_max_sum"),
        F.avg("importi_count").alias("importi_count_mean"), F.coalesce(F.sum(F.col("accounting_relevant").cast("bigint")), F.lit(0)).alias("accounting_relevant_count"),
        F.coalesce(F.sum(F.col("missing_amount_expected").cast("bigint")), F.lit(0)).alias("missing_amount_expected_count"),
    )


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; nulls count as equal. One shuffle, on the key."""
    return df.groupBy(key).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicates"))


CHECKS = [
    ("documenti_senza_categoria", "no_category", "total", "Ampliare le regole o classificare con un modello."),
    ("classificazioni_ambigue", "ambiguous", "total", "Rivedere a mano e usare per la verifica."),
    ("testi_troppo_corti", "short_text", "total", "Controllare riconoscimento e file vuoti."),
    ("tipo_documento_unknown", "unknown_type", "total", "Migliorare le regole su nomi e testi."),
    ("documenti_senza_importi", "no_amount", "total", "Dato descrittivo."),
    ("atti_contabili_senza_importi", "missing_expected", "total", "Migliorare la lettura degli importi."),
    ("testi_duplicati", "duplicate_text", "total", "Togliere i doppi prima di addestrare."),
    ("metadati_senza_tipologia", "meta_no_type", "meta_total", "Ricavare la tipologia dagli allegati."),
    ("metadati_dettaglio_duplicato", "meta_duplicate", "meta_total", "Togliere le righe doppie."),
]


def scorecard(features: DataFrame, notices: DataFrame) -> DataFrame:
    """Nine issues with count, total, percent and priority. Each input is read once for the counts and once for its duplicates."""
    one = features.agg(
        F.count("*").alias("total"), F.count_if(F.col("category").isNull()).alias("no_category"), F.count_if(F.col("classification_confidence") == "ambiguous").alias("ambiguous"),
        F.count_if(F.coalesce("text_words", F.lit(0)) < 120).alias("short_text"), F.count_if(F.coalesce("doc_type", F.lit("unknown")) == "unknown").alias("unknown_type"),
        F.count_if(F.col("importo_max").isNull()).alias("no_amount"), F.count_if(F.coalesce("missing_amount_expected", F.lit(False))).alias("missing_expected"),
    )
    two = notices.agg(F.count("*").alias("meta_total"), F.count_if(F.col("tipologia").isNull()).alias("meta_no_type"))
    dup = duplicates(features, "text_sha256").withColumnRenamed("duplicates", "duplicate_text"), duplicates(notices, "dettaglio_url").withColumnRenamed("duplicates", "meta_duplicate")
    row = one.join(two, F.lit(True)).join(dup[0], F.lit(True)).join(dup[1], F.lit(True))  # four tables of one row
    issues = F.array(*(F.struct(F.lit(n).alias("issue"), F.col(c).cast("bigint").alias("count"), F.col(t).alias("total"), F.lit(r).alias("recommendation")) for n, c, t, r in CHECKS))
    out = row.select(F.inline(issues))
    return out.withColumns({"percent": percent(F.col("count"), F.col("total")), "priority": priority(F.col("count"), F.col("total"))}).orderBy("priority", F.desc("percent"), "issue")


def extremes(df: DataFrame, measure: str, key: str, top: int = 50, largest: bool = True, drop_null: bool = False) -> DataFrame:
    """Rows with the largest or smallest measure, nulls last, ties by key."""
    df = df.filter(F.col(measure).isNotNull()) if drop_null else df
    return df.orderBy(F.col(measure).desc_nulls_last() if largest else F.col(measure).asc_nulls_last(), key).limit(top)


@dataclass
class GateResult:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return 1 if self.errors else 2 if self.warnings else 0


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def gate_counts(features: DataFrame, key: str = "pdf_name") -> DataFrame:
    """What the gate judges: rows, doubles of key and text, share of unknown kinds, missing paths."""
    base = features.agg(F.count("*").alias("rows"), F.count_if(F.coalesce("doc_type", F.lit("unknown")) == "unknown").alias("unknown"), F.count_if(F.col("text_path").isNull()).alias("no_path"))
    base = base.withColumn("unknown_percent", percent(F.col("unknown"), F.col("rows")))
    return base.join(duplicates(features, key).withColumnRenamed("duplicates", "duplicate_keys"), F.lit(True)).join(duplicates(features, "text_sha256").withColumnRenamed("duplicates", "duplicate_texts"), F.lit(True))


def validate(features: DataFrame, required: list[str], key: str = "pdf_name", most_unknown: float = 35.0) -> GateResult:
    out = GateResult()
    if lacking := missing_columns(features, required):
        out.errors.append(f"missing columns: {', '.join(lacking)}")
        return out
    r = gate_counts(features, key).first()
    if r["duplicate_keys"]:
        out.errors.append(f"{r['duplicate_keys']} rows repeat {key}")
    for name, bad, text in (("duplicate_texts", r["duplicate_texts"], "rows repeat a text"), ("unknown_percent", r["unknown_percent"] if r["unknown_percent"] > most_unknown else 0, "percent of unknown kind"), ("no_path", r["no_path"], "rows without text")):
        if bad:
            out.warnings.append(f"{name}: {bad} {text}")
    return out


def summary(issues: DataFrame, rows: int, notices: int, mean_words: float, median_words: float, samples: list[str]) -> str:
    """Markdown report of the collected scorecard (nine rows) and a few samples."""
    lines = ["# Quality", "", f"- documents: {rows}", f"- notices: {notices}", f"- mean words: {mean_words}", f"- median words: {median_words}", "", "| issue | count | percent | priority |", "|-|-|-|-|"]
    lines += [f"| {r['issue']} | {r['count']} | {r['percent']} | {r['priority']} |" for r in issues.collect() if r["count"]]
    return "\n".join([*lines, "", *(f"> {s[:240]}" for s in samples[:3])]) + "\n"
