from scrivano.llm import scanned

COUNTS = {w: 5000 for w in "il procedimento di è stato avviato dalla giunta comunale con delibera della regione nel rione prezzi la spesa finale ogni anno verifica provvedimento socio assistenziale".split()} | {"socio-assistenziale": 900, "di": 60_000}


def cases(text, site=(), title="", counts=COUNTS):
    found = scanned.layout(text, set(site), title)
    words = {x.lower() for x in scanned.WORD.findall(text)} | set(scanned.asked(found[3]))
    rights = {}
    for w in words:
        if not w.isdigit():
            good = [(k, -n, r) for r, n in counts.items() if n >= 40 * max(counts.get(w, 0), 1) and r != w and (k := scanned.replaced(w, r))]
            if good:
                rights[w] = (min(good)[2], -min(good)[1])
    c, out = scanned.examine(text, set(site), found, {w: counts[w] for w in scanned.asked(found[3]) if w in counts}, rights)
    return sorted({(i + 1, k) for i, k in c}), out


def test_broken_words():
    got, out = cases("il procedi-\nmento è stato avviato")
    assert got == [(1, "sillabazione")] and "procedimento è stato" in out
    for sign in "¬­￾‐":
        assert cases(f"il procedi{sign}\nmento è stato")[0] == [(1, "sillabazione")]
    got, out = cases("la spesa socio-\nassistenziale della giunta")
    assert got == [] and "socio-assistenziale" in out
    assert cases("il procedi-\n- 1 -\nmento è\ndalla giunta\n- 2 -")[0] == [(1, "sillabazione"), (2, "pagina"), (5, "pagina")]
    got, out = cases("il procedi-\nIscriviti al notiziario\nmento è", site=[1])
    assert got == [(1, "sillabazione")] and "Iscriviti" not in out and "procedimento è" in out


def test_misread_characters():
    got, out = cases("il proced1mento è 5tato awiato\ndalla giunta")
    assert got == [(1, "carattere")] and "procedimento è stato" in out
    assert cases("nel ri0ne della venfica fmale")[0] == [(1, "carattere")]
    assert cases("entro il 0S/02/2023 per 47O,23")[0] == [(1, "carattere")]
    assert cases("via Verdi 17/B, CIG BRR7FULYG6, Trirbademmano")[0] == []
    assert cases("il proced1-\nmento è")[0] == [(1, "carattere"), (1, "sillabazione")]


def test_headers_and_pages():
    title = "Lavori di restauro conservativo del teatro comunale di Torretta"
    body = ["il procedimento è stato avviato"] * 6
    text = "\n".join(["Delibera 5/2024 - teatro comunale di Torretta", *body, "Pag. 1 di 2", "Delibera 5/2024 - teatro comunale di T0rretta", *body, "Pag. 2 di 2"])
    got = cases(text, title=title)[0]
    assert [x for x in got if x[1] != "carattere"] == [(1, "testatina"), (8, "pagina"), (9, "testatina"), (16, "pagina")]
    text = "\n".join(["conservativo del teatro comunale di Torretta - pag. 1", *body, "conservativo del teatro comunale di Torretta   pagina 2", *body])
    assert cases(text, title=title)[0] == [(1, "pagina"), (1, "testatina"), (8, "pagina"), (8, "testatina")]
    assert cases("\n".join([*body, "84", "€ 562,45", "3)"]))[0] == []  # figures are no page numbers
    assert cases("\n".join(["1", *body, "2", *body]))[0] == [(1, "pagina"), (8, "pagina")]


def test_whole_paragraphs():
    out = cases("il procedimento è\nstato avviato.\nLa spesa finale\nè della giunta.")[1]
    assert out == "il procedimento è stato avviato.\nLa spesa finale è della giunta."


def test_rows(spark):
    rows = [(1, "a", None, "t"), (2, "a", "", "t"), (3, None, "il proce-\ndimento\n" * 3000, None), (4, "a", "  \n ", "t")]
    df = spark.createDataFrame(rows, "doc_key bigint, ente string, text string, oggetto string").selectExpr("*", "1 as site", "2 as cases")
    out = {r["doc_key"]: r for r in scanned.scanned(df).collect()}
    assert [len(out[k]["cases"]) for k in (1, 2, 4)] == [0, 0, 0] and out[1]["text"] is None and out[2]["text"] == ""
    assert len(out[3]["cases"]) >= 3000
    assert scanned.scanned(df.limit(0)).count() == 0


def test_look_alikes_keep_the_shape_of_a_word():
    for wrong, rights in scanned.MISREAD.items():
        for right in rights:
            assert wrong.translate(scanned.STROKES) == right.translate(scanned.STROKES)
            assert scanned.replaced(f"a{wrong}o", f"a{right}o") == 1
    assert scanned.replaced("venfica", "verifica") == 1 and scanned.replaced("5tat0", "stato") == 2
    assert scanned.replaced("provvec1ere", "provvedere") == scanned.replaced("bacrno", "bacino") == scanned.replaced("chsposizione", "disposizione") == 2
    assert scanned.replaced("stato", "stato") is None and scanned.replaced("555555", "ssssss") is None and scanned.replaced("casa", "cosa") is None
    assert scanned.replaced("awiato" * 400, "avviato" * 400) is None


def test_right_words_come_from_the_whole_count_table(spark):
    """The same words are found whatever else the corpus holds; the test is the ratio of two counts."""
    base = [("verifica", 50), ("venfica", 1), ("fra", 30), ("tra", 900), ("unico", 7), ("giunta", 4000), ("giuntа", 3), ("g1unta", 90), ("gíunta", 5)]
    for times in (1, 1000):
        rows = [(w, n * times) for w, n in base] + [(f"parola{chr(97 + k % 26)}{chr(97 + k // 26)}", 50_000 * times) for k in range(200)]
        counts, ask = spark.createDataFrame(rows, "w string, n bigint"), spark.createDataFrame([("venf1ca",), ("unico",)], "w string")
        got = {r["w"]: r["right"] for r in scanned.right_words(counts, ask).collect()}
        assert got == {"venfica": "verifica", "venf1ca": "verifica", "g1unta": "giunta"}


def test_page_numbers_of_an_unknown_form():
    body = ["il procedimento è stato avviato"] * 9
    text = "\n".join(x for k in range(4) for x in [*body, f"foglio nr {k + 1}"])
    assert cases(text)[0] == [(10, "pagina"), (20, "pagina"), (30, "pagina"), (40, "pagina")]
    articles = "\n".join(x for k in range(4) for x in [f"Art. {k + 1}", *body[: 3 + 2 * k]])
    assert cases(articles)[0] == []


def test_compound_with_a_misread_part():
    counts = COUNTS | {"amministrativo": 3000, "tecnico": 3000, "tecnico-amministrativo": 900}
    c, out = cases("il tecnico-\namm1nistrativo è", counts=counts)
    assert c == [(2, "carattere")] and "tecnico-amministrativo è" in out


def test_title_that_goes_on_is_no_header():
    title = "Selezione per n. 16 incarichi presso Area Tecnica, sede di Torretta"
    got = cases("Selezione per n. 16 inca-\nrichi presso Area Tecnica, sede di Torretta\nil procedimento è", title=title)[0]
    assert got == [(1, "sillabazione")]
