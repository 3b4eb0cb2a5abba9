from hypothesis import given, settings
from hypothesis import strategies as st

from scrivano.operators.packed_fields import split_packed, tokenize


def test_separators_quotes_and_brackets():
    assert tokenize("a.pdf;b.pdf | c.pdf\nd.pdf\te.pdf||f.pdf<br>g.pdf") == [f"{c}.pdf" for c in "abcdefg"]
    assert tokenize("1) a.pdf 2) b.pdf") == ["a.pdf", "b.pdf"]
    assert tokenize('"a, b.pdf",c.pdf') == ["a, b.pdf", "c.pdf"]
    assert tokenize('"x ""B"".pdf"; y.pdf') == ['x "B".pdf', "y.pdf"]
    assert tokenize('["a \\"B\\".pdf", "b.pdf"]') == ['a "B".pdf', "b.pdf"]
    assert tokenize("['a.pdf', \"l'elenco.pdf\"]") == ["a.pdf", "l'elenco.pdf"]
    assert tokenize("('a.pdf', 'l\\'elenco.pdf')") == ["a.pdf", "l'elenco.pdf"]
    assert tokenize("['a.pdf', 'b.pdf'") == ["a.pdf", "b.pdf"]
    assert tokenize("[['a.pdf'], ['b.pdf']]") == ["a.pdf", "b.pdf"]


def test_parameters_belong_to_the_value():
    assert tokenize("https://x.example/a.pdf?pos=7,45;b.pdf") == ["https://x.example/a.pdf?pos=7,45", "b.pdf"]
    assert tokenize("a.pdf;v=3, b.pdf") == ["a.pdf;v=3", "b.pdf"]


def test_defined_results():
    assert [tokenize(x) for x in (None, "", " ", "[]", ";,")] == [[]] * 5
    assert tokenize("a.pdf,a.pdf") == ["a.pdf", "a.pdf"]
    assert tokenize('"never closed, b.pdf') == ["never closed", "b.pdf"]
    assert tokenize("l'elenco.pdf") == ["l'elenco.pdf"]
    assert len(tokenize(",".join(f"f{i}.pdf" for i in range(20_000)))) == 20_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.from_regex(r"[A-Za-z]{1,8}[0-9]{0,3}\.pdf", fullmatch=True), min_size=1, max_size=8), st.sampled_from([";", ", ", "|", "\n", "\t", "<br>"]))
def test_round_trip(values, sep):
    assert tokenize(sep.join(values)) == values
    assert tokenize(repr(values)) == values


def test_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "b.pdf;a.pdf;b.pdf", "x"), (2, None, "x"), (3, " ", "x"), (4, "[]", "x")], "k bigint, f string, posizione string")
    assert sorted(map(tuple, split_packed(df, "f", "k").collect())) == [(1, 1, "b.pdf"), (1, 2, "a.pdf"), (1, 3, "b.pdf")]
    assert split_packed(df.limit(0), "f", "k").count() == 0
