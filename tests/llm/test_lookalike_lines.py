import itertools
import random
from collections import defaultdict

from scrivano.llm import lookalike, repeated_lines


def pairs(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'z' as form", "'z' as own")
    return sorted(map(tuple, lookalike.same_look(df).collect()))


def test_same_look(spark):
    base = "La delibera è approvata / n. 5-A"
    same = ["Ｌａ delibera è approvata / n. 5-A", "La deli​bera è approvata / n. 5-A", "La delibera è approvata / n. 5-A", "Lа dеlibera è approvata / n. 5-A", "La delibera è approvata ∕ n. 5‑A", "La delibera è approvata / n. 5-A"]
    got = pairs(spark, [base, *same, base])
    want = sorted((a, b) for a, b in itertools.combinations(range(8), 2) if (a, b) != (0, 7))
    assert got == want


def test_other_look(spark):
    base = "Atto è valido. Riga m2\nfine"
    other = ["atto è valido. Riga m2\nfine", "Atto e valido. Riga m2\nfine", "Atto è valido, Riga m2\nfine", "Atto è valido. Riga m3\nfine", "Atto è valido. Riga m2 fine", "Atto è valido. Riga m²\nfine"]
    assert pairs(spark, [base, *other]) == []


def test_one_foreign_word_in_a_latin_text(spark):
    assert pairs(spark, ["il sole e la luna", "il sole е la luna", "е", "e"]) == [(0, 1)]  # alone it stays in its own script
    assert pairs(spark, ["Повідомлення для мешканців", "Повідомлення для мешканцiв"]) == [(0, 1)]


def test_the_dominant_script_comes_first():
    assert lookalike.repaired("сорa", "latin") == ["сора", "copa"]  # three Cyrillic letters, one Latin
    assert lookalike.repaired("cоpa", "cyrillic") == ["copa", "сора"]
    assert lookalike.repaired("Νе", "latin") == ["Ne"]  # Greek and Cyrillic in an Italian text
    assert lookalike.repaired("Αθήνa", "latin") == []  # no Greek letter looks like a small a
    assert lookalike.repaired("Oδός", "greek") == ["Οδός"]
    assert lookalike.repaired("luna", "latin") == lookalike.repaired("μ", "latin") == []


def test_forms_must_be_words_of_the_corpus(spark):
    ukrainian = "робота має сора і плани на рік"
    assert pairs(spark, [ukrainian, "робота має сорa і плани на рік"]) == [(0, 1)]
    assert pairs(spark, ["una copa di vino", "una сорa di vino"]) == [(0, 1)]  # Latin, for the Cyrillic form is no word
    assert pairs(spark, ["una сорa di vino", "una соpа di vino"]) == []  # no text has the word
    assert pairs(spark, ["Οδός Ερμού", "Oδός Ερμού"]) == [(0, 1)]
    assert pairs(spark, ["плани і робота", "плани i робота"]) == [(0, 1)]


def test_defined_results(spark):
    assert pairs(spark, [None, "", " ", " ", "​", "a", "a"]) == []
    assert lookalike.same_look(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    df = spark.createDataFrame([(1, "ﬁne  x" * 20_000), (2, None), (3, "")], "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in lookalike.in_one_form(df).collect()}
    assert out == {1: "fine  x" * 20_000, 2: None, 3: ""}


def brute(docs):
    import re

    form = lambda s: re.sub(r"\d+", "0", " ".join(s.split()).lower())
    where, total = defaultdict(set), defaultdict(int)
    for key, source, text in docs:
        total[source] += 1
        for line in (text or "").split("\n"):
            where[source, form(line)].add(key)
    out = set()
    for key, source, text in docs:
        for i, line in enumerate((text or "").split("\n"), 1):
            n, letters = len(where[source, form(line)]), sum(c.isalpha() for c in form(line))
            if letters >= 10 and n >= 5 and n >= 0.05 * total[source]:
                out.add((key, i))
    return out


def test_lines_against_brute_force(spark):
    r = random.Random(5)
    lines = ["Iscriviti al notiziario", "Pagina aggiornata il 3/4", "PAGINA  aggiornata il 12/5 ", "breve", "Tutti i diritti riservati", "", "  "]
    docs = []
    for k in range(160):
        body = [r.choice(lines) if r.random() < 0.5 else f"testo proprio dell'atto {''.join(r.choices('abcdefgh', k=9))}" for _ in range(r.randint(0, 9))]
        docs.append((k, r.choice(["a", "a", "a", "b", None]), "\n".join(body) if r.random() < 0.95 else None))
    df = spark.createDataFrame(docs, "doc_key bigint, ente string, text string").selectExpr("*", "1 as src", "2 as lines")
    assert set(map(tuple, repeated_lines.repeated_lines(df).collect())) == brute(docs)
    kept = {x["doc_key"]: x["text"] for x in repeated_lines.without_repeated(df).collect()}
    gone = brute(docs)
    assert kept == {k: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n"), 1) if (k, i) not in gone) for k, _, t in docs}


def test_thresholds_and_empty(spark):
    docs = [(k, "a", "la stessa riga lunga") for k in range(5)] + [(k, "a", "altro") for k in range(5, 100)]
    df = spark.createDataFrame(docs, "doc_key bigint, ente string, text string")
    assert repeated_lines.repeated_lines(df).count() == 5  # just 5 documents and 5 %
    more = spark.createDataFrame([*docs, (100, "a", "x")], df.schema)
    assert repeated_lines.repeated_lines(more).count() == 0
    assert repeated_lines.repeated_lines(df.limit(0)).count() == 0


def test_long_runs_of_repeated_lines(spark):
    text = "\n".join(f"riga comune numero {chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150))
    df = spark.createDataFrame([(k, "a", text) for k in range(6)], "doc_key bigint, ente string, text string")
    assert repeated_lines.repeated_lines(df).count() == 900


def test_blocks_come_from_common_prefixes():
    import numpy as np

    ids = np.array([1, 2, 3] * 5 + [1, 2, 9, 1], np.int64)  # five documents of three lines, one of four
    source, suffix, first = repeated_lines.document_suffixes(np.zeros(6, np.int64), np.array([3, 3, 3, 3, 3, 4]), ids, 3)
    got = {tuple(int(x) for x in b if x): int(n) for b, n in zip(*repeated_lines.stretches(source, suffix, first)[1:])}
    assert {b: n for b, n in got.items() if n >= 5} == {(1,): 6, (1, 2): 6, (1, 2, 3): 5, (2,): 6, (2, 3): 5, (3,): 5}


def test_without_common_prefixes_there_are_no_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(repeated_lines, "common_prefixes", lambda suffixes, apart: np.zeros(len(suffixes), int))
    rows = [(np.array([4, 4, 4, 4, 4, 4]), np.ones(6, int), np.array([5, 6, 7, 8, 9, 5]))]
    for source, lengths, ids in rows:
        source, suffix, first = repeated_lines.document_suffixes(source, lengths, ids, 1)
        assert max(repeated_lines.stretches(np.repeat(source, 5), np.repeat(suffix, 5, axis=0), np.repeat(first, 5, axis=0))[2]) < 5


def test_blocks_over_pieces_of_the_array(spark):
    text = "\n".join(f"riga comune {chr(97 + i)}" for i in range(12))
    docs = [(k, "a" if k % 3 else "b", text if k % 2 else f"{text}\nriga propria {chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(120)]
    df = spark.createDataFrame(docs, "doc_key bigint, ente string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = set(map(tuple, repeated_lines.repeated_lines(df.repartition(6)).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(docs)


def test_repeated_rows_and_one_line_texts(spark):
    docs = [(k % 4, "a", "riga che ritorna sempre") for k in range(8)]
    assert brute(docs) == set()  # four keys; as rows they are eight documents
    df = spark.createDataFrame(docs, "doc_key bigint, ente string, text string")
    assert repeated_lines.repeated_lines(df).count() == 4
