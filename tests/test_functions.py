from datetime import date

import pytest
from pyspark.sql import functions as F

from scrivano.functions import arrays, dates, money, text, urls


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build("x").alias("y")).first()["y"]


@pytest.mark.parametrize("raw, want", [("12.345,67", 12345.67), ("1234,5", 1234.5), ("1.234", 1.234), ("1.234.567", None), ("1,234,567", None), ("100.", 100.0), (".", None), ("", None), (None, None), ("12 345,67", 12345.67), ("1e3", None)])
def test_amount(spark, raw, want):
    assert one(spark, raw, money.amount) == want


def test_amounts_are_case_sensitive_and_counted_twice(spark):
    assert one(spark, "Importo € 5", money.amounts) == [5.0]
    assert one(spark, "importo € 5", money.amounts) == [5.0, 5.0]
    assert one(spark, None, money.amounts) == []


@pytest.mark.parametrize("raw, want", [("14/05/2026", date(2026, 5, 14)), ("2024-01-02", date(2024, 1, 2)), ("2026", date(2026, 1, 1)), ("31/02/2024", None), ("9/2/23", None), (" ", None), (None, None)])
def test_parse_date(spark, raw, want):
    assert one(spark, raw, dates.parse_date) == want


def test_within_and_inferred(spark):
    assert one(spark, None, lambda c: dates.within(c)) is True
    assert one(spark, None, lambda c: dates.within(c, "2024-01-01")) is False
    assert one(spark, "2024", lambda c: dates.within(c, "2024-01-01", "2024-01-01")) is True
    assert one(spark, "pubblicato il 14/05/2026", dates.infer_date) == "14/05/2026"
    assert one(spark, "documento anno 2025", dates.infer_date) == "2025"
    assert one(spark, "Determina n. 12 del", dates.infer_number) == "12"


def test_texts(spark):
    f = text.text_features("x")
    row = spark.createDataFrame([("CIG cig è l'importo di 5 euro, € 3 il 1/2/2024 e 2025, 20256",)], "x string").select(*(v.alias(k) for k, v in f.items())).first()
    assert (row["cig_mentions"], row["euro_mentions"], row["date_mentions"], row["years_mentioned"]) == (2, 2, 1, "2024,2025")
    assert one(spark, None, lambda c: text.text_features(c)["text_words"]) == 0
    assert one(spark, " a  b\x01c\n", text.normalized) == "a b c"
    assert one(spark, "  Atto n. 1/è  ", text.slug) == "Atto_n._1è" and one(spark, "///", text.slug) == "file" and one(spark, None, text.slug) == "file"
    assert one(spark, "a b", text.cache_key) == "a_b"


@pytest.mark.parametrize("part, whole, percent, priority", [(726, 1047, 69.34, 1), (92, 759, 12.12, 2), (31, 759, 4.08, 3), (0, 759, 0.0, 4), (0, 0, 0.0, 4)])
def test_percent_priority(spark, part, whole, percent, priority):
    row = spark.createDataFrame([(part, whole)], "a bigint, b bigint").select(text.percent(F.col("a"), F.col("b")).alias("p"), text.priority(F.col("a"), F.col("b")).alias("q")).first()
    assert (row["p"], row["q"]) == (percent, priority)


def test_urls(spark):
    u = "https://a.example/getdoc.php?id=3&file=x/Atto_1.pdf.p7m"
    assert one(spark, u, urls.document_name) == "Atto_1.pdf.p7m"
    assert one(spark, "https://a.example/b/c.pdf?x=1", urls.document_name) == "c.pdf"
    assert one(spark, None, urls.document_name) == ""
    assert one(spark, u, urls.is_attachment) is True and one(spark, "https://a.example/x", urls.is_attachment) is False
    assert one(spark, "https://a.example/l?pagina=2&z=1", urls.next_page) == "https://a.example/l?pagina=3&z=1"
    assert one(spark, "https://a.example/l", urls.next_page) == "https://a.example/l?pagina=2"
    assert one(spark, u, urls.extension) == ".p7m" and one(spark, "https://a.example/x", urls.extension) == ".bin"
    assert one(spark, "https://a.example/?csrf=t1", lambda c: urls.token_of(c, F.lit(None))) == "t1"


def test_lists_and_keys(spark):
    assert one(spark, "['u1', 'u2']", arrays.listed) == ["u1", "u2"]
    assert one(spark, "u1|u2", arrays.listed) == ["u1", "u2"]
    assert one(spark, " u1 ; ; u2", arrays.listed) == ["u1", "u2"]  # blanks around values are dropped, at any place
    assert one(spark, " ", arrays.listed) == [] and one(spark, None, arrays.listed) == []
    assert one(spark, "", lambda c: arrays.notice_key(c, F.array(F.lit("a")))) == "a"
    assert len(one(spark, None, lambda c: arrays.notice_key(c, F.array().cast("array<string>"), c))) == 40


def test_start_of_the_next_page(spark):
    from scrivano.functions import urls

    df = spark.createDataFrame([(1, 1), (3, 21), (3, 400), (2, 16), (None, 5)], "page int, start int")
    assert [r[0] for r in df.select(urls.next_start("page", "start")).collect()] == [16, 31, 46, 31, None]
