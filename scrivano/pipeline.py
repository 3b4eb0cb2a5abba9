"""One run over a folder of tables: extract, classify, roll up, judge, write.

    python -m scrivano.pipeline --input FOLDER --output FOLDER [--strict] [--most-unknown 35]

The plan is one chain of projections; its result is written once and every report reads that table."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivano.config import Settings
from scrivano.operators import classify, extract, quality
from scrivano.session import build_session, table
from scrivano.sources.writers import write_tables, write_text

REQUIRED = ["pdf_name", "doc_type", "category", "text_sha256", "text_path", "text_words", "importo_max"]


def features(docs: DataFrame, strict: bool = False) -> DataFrame:
    """Fields, amounts, measures, kind and category of every document."""
    kept = docs.select("doc_key", "ente", "pdf_name", "text_path", "text")
    found = extract.extracted(kept, strict=strict).withColumn("doc_type", classify.document_kind("pdf_name", "text"))
    found = classify.classified(found)
    found = found.withColumn("accounting_relevant", classify.about_money("text", "doc_type", "category"))
    expected = F.col("accounting_relevant") & (F.col("doc_type") != "VistoContabile") & (F.col("importi_count") == 0)
    return found.withColumn("missing_amount_expected", expected).drop("text")


def reports(found: DataFrame, notices: DataFrame) -> dict[str, DataFrame]:
    """Every table of the report."""
    kinds = [label for label, _ in classify.NAME_RULES] + ["unknown"]
    return {
        "quality_issues": quality.scorecard(found, notices),
        **{f"{c}_distribution": quality.distribution(found, c) for c in ("category", "doc_type", "classification_confidence")},
        "category_numeric_profile": quality.numeric_profile(found),
        "category_kind_matrix": quality.crosstab(found, "category", "doc_type", kinds),
        "short_text_documents": quality.extremes(found, "text_words", "doc_key", largest=False),
        "long_text_documents": quality.extremes(found, "text_words", "doc_key"),
        "top_amounts": quality.extremes(found, "importo_max", "doc_key", drop_null=True),
        "supplier_ranking": found.filter("beneficiario is not null").groupBy("beneficiario").agg(quality.money_sum("importo_max").alias("importo_totale")).orderBy(F.desc("importo_totale"), "beneficiario").limit(50),
    }


def run(spark: SparkSession, source: str, target: str, strict: bool = False, settings: Settings | None = None) -> quality.GateResult:
    """Writes features, report tables and the summary; returns the judgement of the gate."""
    settings = settings or Settings()
    notices = table(spark, source, "albo_metadati")
    features(table(spark, source, "documenti_corpus"), strict).write.mode("overwrite").parquet(f"{target}/features")
    found = spark.read.parquet(f"{target}/features")
    tables = reports(found, notices)
    write_tables(tables, f"{target}/report")
    words = found.agg(F.round(F.avg(F.coalesce("text_words", F.lit(0))), 1), F.median(F.coalesce("text_words", F.lit(0))), F.count("*")).first()
    samples = [r[0] for r in found.filter("text_preview != ''").orderBy("doc_key").select("text_preview").limit(3).collect()]
    write_text(quality.summary(spark.read.parquet(f"{target}/report/quality_issues"), words[2], notices.count(), words[0], words[1], samples), f"{target}/report.md", spark)
    return quality.validate(found, REQUIRED, "doc_key", settings.most_unknown)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--strict", action="store_true", help="shorter names only, and amounts of table cells")
    p.add_argument("--most-unknown", type=float, default=35.0, help="percent of documents of unknown kind that is still fine")
    a = p.parse_args(args)
    result = run(build_session("pipeline"), a.input, a.output, a.strict, Settings(most_unknown=a.most_unknown))
    for kind, lines in (("error", result.errors), ("warning", result.warnings)):
        for line in lines:
            print(f"{kind}: {line}")
    return result.exit_code


if __name__ == "__main__":
    raise SystemExit(main())
