import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scrivano.llm import encode, packing

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def known():
    t = tokenizers.Tokenizer.from_file(encode.BYTE_BPE_50K.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


TEXTS = ["", " ", "Determina n. 12", "l'atto è approvato\n\n  fine", "<|endoftext|> ordinario", "a" * 3000, "-" * 400, " " * 500 + "x", "日本語 текст العربية 😀", "it's we'll 12²³ \x1c y"]


def test_same_ids_as_the_library(known):
    e = encode.Encoder()
    for t in TEXTS:
        assert e.encode(t) == known(t)
    assert e.encode(None) == []


def test_appends_and_edits_are_exact(known):
    e, r = encode.Encoder(), random.Random(1)
    for _ in range(60):
        t = "".join(r.choice(["atto ", "n. 12 ", "è\n", "  ", "l'ente", "'ll", "x"]) for _ in range(20))
        state = e.append(e.encoded(t), r.choice(["'ll", " x", "\n\n", "y"]))
        assert state[1] == known(state[0])
        a = r.randint(0, len(state[0]))
        state = e.edit(state, a, min(len(state[0]), a + 3), r.choice(["", " ", "zz", "'s"]))
        assert state[1] == known(state[0])


def test_prefix_table_stops_where_it_agrees_again():
    e = encode.Encoder()
    table = encode.PrefixTable(e.vocabulary, b"deliberazione della giunta comunale " * 30)
    assert table.replace(10, 12, b"Q") < 400
    assert table.last == encode.PrefixTable(e.vocabulary, table.data).last


def test_rows(spark, known):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None])], "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode.encode_ids(df).collect()}
    assert got == {i: (known(t) if t else []) for i, t in enumerate([*TEXTS, None])}
    assert encode.encode_ids(df.limit(0)).count() == 0
    assert {r["doc_id"]: r["tokens"] for r in encode.token_counts(df).collect()} == {k: len(v) for k, v in got.items()}


def test_plan_keeps_every_item_and_the_capacity():
    r = random.Random(2)
    for _ in range(150):
        cap = r.choice([1, 2, 7, 50, 200])
        items = [r.randint(1, cap) for _ in range(r.randint(0, 300))]
        plan, used = packing.fill_plan(Counter(items), cap), Counter()
        for lengths, n in plan:
            assert sum(lengths) <= cap and n > 0
            for x in lengths:
                used[x] += n
        assert used == Counter(items)


def test_exact_complements_leave_nothing():
    assert packing.fill_plan(Counter({70: 3, 20: 3, 10: 3}), 100) == [((70, 20, 10), 3)]
    assert packing.fill_plan(Counter({40: 1, 30: 1, 20: 1, 10: 1}), 100) == [((40, 30, 20, 10), 1)]


def test_packed_rows(spark):
    sizes = [(i, n) for i, n in enumerate([5, 5, 5, 25, 0, None, 10, 3, 7, 1])]
    df = spark.createDataFrame(sizes, "doc_id bigint, tokens bigint").withColumn("contenitore", F.lit("x"))
    caps = spark.createDataFrame([("a", 10), ("b", 100), ("none", None)], "contesto string, capacita bigint")
    rows = packing.pack(df, caps).collect()
    for name, cap in (("a", 10), ("b", 100)):
        own = [r for r in rows if r["contesto"] == name]
        assert {r["doc_id"] for r in own} == set(range(10))
        fill = Counter()
        for r in own:
            fill[r["contenitore"]] += r["lunghezza"]
        assert max(v for k, v in fill.items() if k is not None) <= cap
        whole = Counter()
        for r in own:
            whole[r["doc_id"]] += r["lunghezza"]
        assert whole == Counter({i: n or 0 for i, n in sizes})
    assert {r["parte"] for r in rows if r["contesto"] == "a" and r["doc_id"] == 3} == {1, 2, 3}
    assert all(r["contenitore"] is None for r in rows if r["lunghezza"] == 0)
    assert packing.pack(df.limit(0), caps).count() == 0


def test_a_length_shared_by_most_items(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1200, 7).otherwise(F.col("id") % 50 + 1).alias("tokens"))
    rows = packing.pack(df, spark.createDataFrame([("a", 64)], "contesto string, capacita bigint"))
    fill = rows.groupBy("contenitore").agg(F.sum("lunghezza").alias("s"))
    total = rows.agg(F.sum("lunghezza")).first()[0]
    assert rows.count() == 3000 and fill.agg(F.max("s")).first()[0] <= 64 and fill.count() <= -(-total // 64) + 2
