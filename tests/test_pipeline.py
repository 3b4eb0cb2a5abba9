from pathlib import Path

import pytest

from scrivano import pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_whole_run(spark, tmp_path):
    result = pipeline.run(spark, FOLDER, str(tmp_path))
    assert result.errors == [] and result.exit_code in (0, 2)
    docs = spark.read.parquet(f"{FOLDER}/documenti_corpus.parquet").count()
    found = spark.read.parquet(f"{tmp_path}/features")
    assert found.count() == docs
    report = lambda name: spark.read.parquet(f"{tmp_path}/report/{name}")
    assert report("quality_issues").count() == 9
    assert report("doc_type_distribution").agg({"count": "sum"}).first()[0] == docs
    profile = report("category_numeric_profile")
    assert profile.agg({"docs": "sum"}).first()[0] == docs
    matrix = report("category_kind_matrix")
    assert sum(sum(r[1:]) for r in matrix.collect()) == docs
    assert 0 <= min(r["percent"] for r in report("quality_issues").collect()) <= max(r["percent"] for r in report("quality_issues").collect()) <= 100
    assert (tmp_path / "report.md").read_text().startswith("# Quality")


def test_empty_input(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_key bigint, ente string, pdf_name string, text_path string, text string")
    assert pipeline.features(docs).count() == 0
