import pytest
from pyspark.sql import functions as F

from scrivano.config import Settings, listed_setting
from scrivano.errors import AllModelsFailed, ConfigError, QuotaError
from scrivano.operators import answers, classify, clean, extract, incremental, measures, ml, quality, retrieval
from scrivano.sources import pages, readers, writers


def test_kinds_and_categories(spark):
    df = spark.createDataFrame([("x_Determina_Avviso.pdf", "manutenzione straordinaria", "cantiere"), (None, None, None), ("a.pdf", "tribunale ambiente", "")], "pdf_name string, oggetto string, text string")
    out = classify.classified(df.withColumn("kind", classify.document_kind("pdf_name", "text"))).collect()
    assert [r["kind"] for r in out] == ["Determinazione", "unknown", "unknown"]
    assert (out[0]["category"], out[0]["classification_confidence"]) == ("Lavori Pubblici", "high")
    assert out[1]["category"] is None and out[1]["classification_confidence"] is None
    assert (out[2]["category"], out[2]["classification_confidence"]) == ("Ambiente", "ambiguous")  # tie: first by name
    money = spark.createDataFrame([("occupazione", "Avviso", None), ("x", "Decreto", None), (None, None, None)], "t string, k string, c string")
    assert [r[0] for r in money.select(classify.about_money("t", "k", "c")).collect()] == [True, False, False]


def test_fields(spark):
    t = "OGGETTO: Lavori in via A Visto il parere N. 12 DEL 01/02/2024 C.I.G.: ab12345678 capitolo 3.09 impegno n. 7 per importo € 1.000,50"
    df = spark.createDataFrame([(1, "VistoContabile_1.pdf", t), (2, None, None)], "doc_key int, pdf_name string, text string")
    a, b = extract.extracted(df).orderBy("doc_key").collect()
    assert (a["oggetto"], a["numero_atto"], a["data_atto"], a["cig"], a["capitolo"], a["impegno_num"]) == ("Lavori in via A", "12", "01/02/2024", "AB12345678", "3.09", "7")
    assert (a["importo_max"], a["importi_count"], a["is_visto_contabile"]) == (1000.5, 2, True)
    assert b["oggetto"] is None and b["importo_sum"] is None and b["importi_count"] == 0
    over = spark.createDataFrame([("VistoContabile_1.pdf", " ")], "pdf_name string, text string")
    assert extract.with_overrides(df, over, "pdf_name", ["text"]).filter("doc_key = 1").first()["text"] == t


def test_quality(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "x", None), (None, "x", 2.5), (None, None, None)], "k string, c string, importo_max double")
    assert quality.duplicates(df, "k").first()[0] == 2  # nulls count as equal
    assert quality.duplicates(df.limit(0), "k").first()[0] == 0
    assert [tuple(r) for r in quality.distribution(df, "c").collect()] == [("<vuoto>", 2), ("x", 2)]
    assert df.filter("importo_max is null").agg(quality.money_sum("importo_max")).first()[0] == 0.0
    full = spark.createDataFrame([("f", "unknown", "h", None)], "pdf_name string, doc_type string, text_sha256 string, text_path string")
    gate = quality.validate(full.unionAll(full), ["pdf_name"])
    assert gate.exit_code == 1 and len(gate.warnings) == 3
    assert quality.validate(full, ["nothing"]).errors and quality.GateResult().exit_code == 0


def test_incremental(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, "a", "q"), (3, "b", "r"), (4, None, "s"), (5, "c", "t")], "id int, k string, v string")
    seen = spark.createDataFrame([("b",)], "seen string")
    assert sorted(r["id"] for r in incremental.unseen(df, seen, "k", "id").collect()) == [1, 5]
    new = spark.createDataFrame([("a", 1, "X"), ("a", 2, None)], "k string, o int, v string")
    assert [r["v"] for r in incremental.updated(df, new, "k", "o", ["v"]).orderBy("id").collect()] == [None, None, "r", "s", "t"]  # the last change counts, null or not
    both = incremental.suffixed_join(df, df.select("k", "v"), "k", "_r")
    assert both.columns == ["k", "id", "v", "v_r"]
    assert incremental.with_failures(df, spark.createDataFrame([("z", "bad")], "k string, reason string")).count() == 6


def test_cleaning(spark):
    df = spark.createDataFrame([("COMUNE DI X (Provincia di Y) Città d'Arte\nRegistro Generale N. 5 DEL 01/01/2024 testo  qui\n\n\n\nX (YY), 01/02/2024 Il Segretario Comunale f.to Z\nATTESTAZIONE DI CONFORMITÀ a b\nc repertorio generale dell’Ente.fine",), (None,)], "text string")
    out = [r["text"] for r in clean.refreshed(df, places=("X",)).collect()]
    assert out == ["testo qui\n\nfine", ""]


def test_chunks_and_search(spark):
    text = ("frase numero uno. " * 500 + "\n\n" + "x" * 7000)
    parts = retrieval.split_text(text)
    assert all(len(p) <= 3000 for p in parts) and "".join(text.split())[:200] in "".join("".join(parts).split()) and retrieval.split_text(" ") == []
    docs = spark.createDataFrame([(1, "alfa beta gamma"), (2, "alfa beta"), (3, None), (4, "beta alfa")], "id int, text string")
    q = spark.createDataFrame([(9, "ALFA beta"), (8, "???"), (7, None)], "question_id int, q string")
    hits = retrieval.overlap_search(q, "q", docs, "id").orderBy("rank").collect()
    assert [(r["id"], r["overlap"]) for r in hits] == [(1, 2), (2, 2), (4, 2)]
    assert docs.select(retrieval.prefixed(F.lit("S"), F.lit(" "), F.lit(None), F.lit("c"))).first()[0] == "Oggetto: S.\n\nc"
    vec = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(6)] + [(9, None)], "vec_id bigint, embedding array<float>")
    near = retrieval.vector_search(vec, F.col("vec_id") == 2, top=3).orderBy("rank").collect()
    assert [(r["vec_id"], r["distance"]) for r in near] == [(1, 1.0), (3, 1.0), (0, 4.0)]


def test_measures(spark):
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00", 1, 5.0), ("a", "2024-01-02 10:00:00", 2, 3.0), ("a", None, 3, None), ("b", "2024-01-01 09:00:00", 4, 512.0)], "m string, t string, id int, v double").withColumn("t", F.to_timestamp("t"))
    out = {r["id"]: r["running"] for r in measures.running(df, ["m"], ["t", "id"], "v").collect()}
    assert out == {1: 5.0, 2: 8.0, 3: 0.0, 4: 512.0}
    assert {r["m"]: r["value"] for r in measures.gauges(df.filter("v is not null"), ["m"], ["t"], "v").collect()} == {"a": 3.0, "b": 512.0}
    hits = spark.createDataFrame([(True,), (True,), (False,)], "h boolean")
    assert measures.hit_rate(hits, F.col("h")).first()["hit_rate"] == pytest.approx(2 / 3, abs=1e-6)
    assert measures.hit_rate(hits.limit(0), F.col("h")).first()["hit_rate"] == 0.0
    log = spark.createDataFrame([("k1", 1), ("k2", 2), ("k3", 3), ("k1", 4), ("k4", 5)], "k string, t int")
    assert [r["k"] for r in measures.least_recently_used(log, "k", "t", 3).collect()] == ["k2"]


def test_labels(spark):
    df = spark.createDataFrame([(i, "a" if i < 7 else "b") for i in range(9)], "id int, y string")
    n = {r["y"]: r["count"] for r in ml.oversampled(df, "y", "id").groupBy("y").count().collect()}
    assert n == {"a": 7, "b": 7}
    report = {r["label"]: r for r in ml.class_report(spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "t string, g string"), "t", "g").collect()}
    assert (report["a"]["precision"], report["a"]["recall"], report["b"]["precision"], report["c"]["recall"]) == (0.5, 0.5, 0.0, 0.0)


def test_failover_and_settings():
    now = [0.0]

    def broken(_):
        raise QuotaError("429")

    f = answers.Failover({"a": broken, "b": lambda p: p.upper()}, 60, lambda: now[0])
    assert f.ask("x") == ("b", "X") and "a" in f.resting
    g = answers.Failover({"a": broken}, 60, lambda: now[0])
    for _ in range(2):
        with pytest.raises(AllModelsFailed):
            g.ask("x")
    assert answers.mode([], True) == "local" and answers.mode(["m"], False) == "lexical"
    assert "Nessun" in answers.local_answer("q", [])
    assert listed_setting("m-a, m-b") == ["m-a", "m-b"] == listed_setting('["m-a", "m-b"]')
    assert Settings.from_environment(env={"SCRIVANO_TOP_K": "4", "SCRIVANO_MODELS": "x"}).top_k == 4
    with pytest.raises(ConfigError) as e:
        Settings(top_k=0)
    assert e.value.to_dict()["error_type"] == "ConfigError"


HTML = '<html><title>T</title><ul><li><a href="d?id=1">Atto n. 5</a> 01/02/2024</li><li><a href="l?p=2" rel="next">successiva</a></li></ul></html>'


def test_pages(spark):
    df = spark.createDataFrame([("https://a.example/l", HTML), ("https://a.example/m", None), ("https://a.example/n", "")], "url string, html string")
    assert [tuple(r) for r in pages.listed_notices(df).collect()] == [("https://a.example/l", "https://a.example/d?id=1", "Atto n. 5", "5", "01/02/2024", None)]
    kinds = spark.createDataFrame([("u", "<table><tr><td>DELIBERA di giunta</td><td><a href='x'>y</a></td></tr></table>")], "url string, html string")
    assert [r["tipologia"] for r in pages.listed_notices(kinds).collect()] == ["Delibera"]
    assert pages.next_link("https://a.example/l", HTML) == "https://a.example/l?p=2"
    assert pages.detail("https://a.example/d", "<p>Oggetto: Lavori</p><a href='x.pdf'>f</a><a href='x.pdf'>f</a>") == ("Lavori", None, ["https://a.example/x.pdf"])


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert writers.write_tables({"una_tabella_con_un_nome_molto_lungo": df}, str(tmp_path / "t")) == ["una_tabella_con_un_nome_molto_l"]
    got, problems = readers.checked_table(spark, str(tmp_path / "t" / "una_tabella_con_un_nome_molto_l"), ["k", "z"])
    assert got.count() == 1 and len(problems) == 1 and readers.checked_table(spark, str(tmp_path / "none"), [])[0] is None
    writers.replace_table(got.withColumn("n", F.col("n") + 1), str(tmp_path / "t" / "una_tabella_con_un_nome_molto_l"))
    assert spark.read.parquet(str(tmp_path / "t" / "una_tabella_con_un_nome_molto_l")).first()["n"] == 2
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "f" / "b.php").write_bytes(b"<html>")
    (tmp_path / "f" / "c.txt").write_text("testo\nintero")
    files = readers.read_files(spark, str(tmp_path / "f"))
    good, bad = readers.quarantine(files)
    assert (good.count(), [r["reason"] for r in bad.collect()]) == (1, ["missing_pdf_signature"])
    assert readers.same_manifest(readers.fingerprints(files), readers.fingerprints(files))
    assert {r["reason"] for r in readers.file_texts(files, lambda b: b.decode() if b[:1] == b"%" else 1 / 0).collect()} == {None, "ZeroDivisionError"}
    assert readers.read_texts(spark, str(tmp_path / "f")).first()["text"] == "testo\nintero"
    (tmp_path / "l.jsonl").write_text('{"c": "NaN", "v": NaN}\n{"c": "x", "v": 1}\n')
    assert [r["c"] for r in readers.read_lines(spark, str(tmp_path / "l.jsonl"), "c string, v double").collect()] == [None, "x"]
    assert readers.with_columns(df, {"k": "string", "m": "double"}).columns == ["k", "n", "m"]


def test_streams(spark, tmp_path):
    from scrivano.streaming import incremental as s

    df = spark.createDataFrame([("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-01 11:00:00", 2.0), ("b", "2024-01-02 11:00:00", 4.0)], "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    df.write.parquet(str(tmp_path / "in"))
    for name, build in (("once", lambda x: s.new_notices(x, "k", "t")), ("sums", lambda x: s.windowed(x, "k", "t", "v"))):
        q = build(s.arriving(spark, str(tmp_path / "in"), df.schema)).writeStream.format("memory").queryName(name).outputMode("append" if name == "once" else "update").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert spark.sql("select count(*) from once").first()[0] == 2
    assert spark.sql("select sum(total) from sums").first()[0] == 7.0
