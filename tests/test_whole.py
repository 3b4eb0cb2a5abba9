"""Queries that must take in every row and the whole of each text."""

import ast
from collections import Counter

from scrivano.operators import ml, retrieval
from scrivano.plans import core


def test_every_chunk_has_the_prefix(spark, tmp_path):
    long = "frase numero uno. " * 500
    rows = [(1, long, " Lavori  di\nscavo ", "C1", None), (2, "breve " * 10, "N/D", None, " "), (3, "x", "S", None, None), (4, None, "S", None, None)]
    spark.createDataFrame(rows, "doc_key bigint, text string, oggetto string, cig string, cup string").write.parquet(str(tmp_path / "documenti_corpus.parquet"))
    got = [tuple(r) for r in core.QUERIES["chunk_prefix_all"](spark, str(tmp_path)).orderBy("doc_key", "chunk_no").collect()]
    parts = retrieval.split_text(long)
    assert len(parts) > 3 and got == [(1, i, "Oggetto: Lavori di scavo. CIG: C1.\n\n" + p) for i, p in enumerate(parts)] + [(2, 0, "breve " * 10)]


def literal(field):
    """The list of a field by brute force."""
    s = (field or "").strip()
    try:
        return ast.literal_eval(s)
    except (SyntaxError, ValueError):
        return next(([p.strip() for p in s.split(c) if p.strip()] for c in ";|" if c in s), [s] if s else [])


def test_every_notice_is_listed(spark, tmp_path):
    fields = ["['a.pdf', 'b; c.pdf']", "[\"l'a.pdf\", 'b.pdf']", "['a.pdf', 'b.pdf'", '["a.pdf", "b.pdf"', '["a.pdf", "b|c.pdf"]', "a.pdf; b.pdf ;", "a.pdf|b.pdf", "a.pdf", "[]", " ", None]
    spark.createDataFrame(list(enumerate(fields)), "atto_id bigint, allegati string").write.parquet(str(tmp_path / "albo_metadati.parquet"))
    got = Counter(tuple(r) for r in core.QUERIES["listed_attachments_all"](spark, str(tmp_path)).collect())
    assert got == Counter((i, v) for i, f in enumerate(fields) for v in literal(f))


def test_forest_sees_each_label_as_often(spark):
    rows = [(i, "scavo strada" if i % 2 else "nido mensa", "a" if i < 40 else "b") for i in range(44)]  # words that say nothing of the label
    df = spark.createDataFrame(rows, "id int, text string, y string")
    forest = ml.text_forest("text", "y", trees=20, depth=3)
    model = ml.fitted_balanced(forest, df, "y", "id")
    share = {m: m.transform(df).first()["_prob"][m.stages[0].labels.index("b")] for m in (model, forest.fit(df))}
    assert 0.3 < share.pop(model) < 0.7 and share.popitem()[1] < 0.3


def test_forest_of_the_query_is_whole(spark, monkeypatch):
    """The query takes the operator's own number of trees and depth, and balanced rows."""
    asked, whole = [], ml.text_forest

    def small(*args, **kwargs):
        asked.append((args, kwargs))
        return whole(*args, **kwargs, words=50, trees=2, depth=2) if not kwargs else whole(*args, **kwargs)

    balanced = []
    monkeypatch.setattr(ml, "text_forest", small)
    monkeypatch.setattr(ml, "oversampled", lambda *a, f=ml.oversampled: balanced.append(a[1]) or f(*a))
    core.QUERIES["forest_labels"](spark, "/root/testdata/sf0.001")
    assert asked == [(("text", "category"), {})] and balanced == ["category"]


def test_first_notices_gather_no_whole_page(spark):
    plan = core.QUERIES["first_notices_of_pages"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "collect_list" not in plan
