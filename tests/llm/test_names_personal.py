import random

import numpy as np
import pytest

from scrivano.llm import labelled, name_variants, personal

SAME = [
    ("Ezio Barmanetti", "BARMANETTI, EZIO"), ("Ezio Barmanetti", "E. Barmanetti"), ("Filippo Cortelasco", "pippo cortelasco"), ("Anna Rita Dalmeraldi", "Dalmeraldi Annarita"), ("Filippo Cortelasco", "Filipo Cortelasco"), ("Ezio Barmanetti", "dott. Ezio P. Barmanetti"),
    ("Tornex Impianti S.r.l.", "ditta tornex imp.ti società a responsabilità limitata"), ("Tornex Impianti S.r.l.", "IMPIANTI TORNEX"), ("Tornex Impianti S.r.l.", "Tornex srl"), ("Acquedotto Valle Verde S.p.A.", "A.V.V. spa"), ("Ezio Barmanetti", "Ezio Barmanetti tel. 305 1234567"),
    ("Ezio Barmanetti", "Ezio Barmanetti, via dei Tigli, 3"), ("Ezio Barmanetti", " Ezio  Barmanetti - C.F. BRMZEI60A01Y111Z"),
]
OTHER = [("Ezio Barmanetti", "Ines Barmanetti"), ("Tornex Impianti S.r.l.", "Tornex Vivai S.r.l."), ("Tornex Impianti S.r.l.", "Tornex Impianti S.p.A."), ("Luigi Sassocolli", "Luigi Barmanetti"), ("Diversi", "N.D.")]


def linked(spark, names):
    df = spark.createDataFrame([("beneficiario", n, "x") for n in names], "campo string, nome string, entity string")
    return {(r["nome_a"], r["nome_b"]) for r in name_variants.variant_pairs(df.select("campo", "nome")).collect()}


def test_entities(spark):
    names = sorted({n for p in [*SAME, *OTHER] for n in p}) + [None, "", "-", "creditori diversi"]
    got = linked(spark, names)
    missing = [p for p in SAME if tuple(sorted(p)) not in got and "Tornex srl" not in p and "IMPIANTI TORNEX" not in p]
    assert missing == [] and [p for p in OTHER if tuple(sorted(p)) in got] == []


def test_short_form_that_fits_two_names_links_to_neither(spark):
    got = linked(spark, ["Ezio Barmanetti", "Ines Barmanetti", "Barmanetti", "BARMANETTI EZIO", "BARMANETTI INES"])
    assert got == {("BARMANETTI EZIO", "Ezio Barmanetti"), ("BARMANETTI INES", "Ines Barmanetti")}


def test_no_names(spark):
    empty = spark.createDataFrame([], "campo string, nome string")
    assert name_variants.variant_pairs(empty).count() == 0
    assert linked(spark, [None, "", "Diversi", "diversi"]) == set()
    assert linked(spark, ["A" * 5000 + " B", "a" * 5000 + " b"]) == {("A" * 5000 + " B", "a" * 5000 + " b")}


def test_bands_meet_as_the_curve_says():
    r = random.Random(4)
    words = ["".join(r.choices("abcdefghilmnoprstuvz", k=11)) for _ in range(300)]
    met = 0
    for w in words:
        i = r.randrange(1, 10)
        other = w[:i] + r.choice("abcdefghilm") + w[i + 1 :]
        met += bool(set(name_variants.bands([w])) & set(name_variants.bands([other])))
    assert met >= 0.97 * len(words)


def test_links_do_not_depend_on_how_often_words_occur(spark):
    givens = sorted(name_variants.GIVEN - {"maria", "mariagrazia", "gian", "pier"})[:40]
    names = [f"{g.title()} Barmanetti" for g in givens] + [f"{g.title()} Barmanettti" for g in givens[:20]]
    got = linked(spark, names)
    assert {tuple(sorted((f"{g.title()} Barmanetti", f"{g.title()} Barmanettti"))) for g in givens[:20]} <= got
    assert name_variants.compare(["rossi"], ["rosssi"], "", "")[0] > 0.8


def test_only_neighbouring_keys_are_slips():
    assert name_variants.word_similarity("barmanetti", "batmanetti") == 0.9  # t lies beside r
    assert name_variants.word_similarity("tolmetis", "colmepis") == 0  # two letters of far keys make another name
    assert name_variants.word_similarity("brurbodia", "brurbovia") > 0.7  # one may be a slip
    assert name_variants.word_similarity("peppe", "beppe") == name_variants.word_similarity("nino", "tonino") == 0.95


def test_keys_of_busy_heads_find_what_direct_pairs_find(spark, monkeypatch):
    r = random.Random(8)
    names = set()
    for k in range(140):
        g, last = r.choice(sorted(name_variants.GIVEN)), r.choice(["Barmanetti", "Dalmeraldi", "Tornex"])
        i = r.randrange(len(g) - 1)
        g = r.choice([g, g, g[:i] + g[i + 1] + g[i] + g[i + 2 :], g[:i] + g[i] + g[i:], g[0] + ".", r.choice(sorted(name_variants.SHORT)), g + " p.", g + " " + r.choice(["carlo", "anna"]), "manut. strad.", "manutenzioni stradali", "gian luca", "gianluca", ""])
        names.add(r.choice([f"{g} {last}", f"{last} {g}"]).strip())
    nodes = [("beneficiario", n, "x") for n in sorted(names)]
    df = spark.createDataFrame(nodes, "campo string, nome string, entity string").select("campo", "nome")
    seen = []
    for few in (0, 10**9):
        monkeypatch.setattr(name_variants, "FEW", few)
        links = []
        original = name_variants.stars
        monkeypatch.setattr(name_variants, "stars", lambda n, x, links=links, original=original: (links.extend((r["a"], r["b"]) for r in x.collect()), original(n, x))[1])
        name_variants.variants(df).count()
        monkeypatch.setattr(name_variants, "stars", original)
        seen.append(set(links))
        assert len(links) == len(set(links))
    assert seen[0] == seen[1] and len(seen[0]) > 50


def test_names_that_only_look_alike_are_no_candidates(spark):
    """Made-up surnames share most of their syllables; the names to be compared follow the number of names, not its square."""
    r = random.Random(3)
    last = sorted({"".join(r.choice(["bar", "cor", "dal", "fen", "gri", "mon", "pel", "sta", "tor", "vil"]) for _ in range(3)) + r.choice(["etti", "asco", "eraldi", "ovani"]) for _ in range(1500)})
    rows = [(k, [g, w], "") for k, (w, g) in enumerate((w, r.choice(["ezio", "ines", "ugo"])) for w in last)] + [(len(last) + k, ["ezio", w[:4] + w[5:]], "") for k, w in enumerate(last[:20])]
    df = spark.createDataFrame([(n, w, sorted(set(name_variants.distinctive(w))), f) for n, w, f in rows], "node bigint, words array<string>, own array<string>, form string")
    df = df.selectExpr("*", "'x' as campo", "xxhash64(own) as head", "false as acronym", "cast(array() as array<string>) as acronyms")
    got = {tuple(x) for x in name_variants.candidates(df).collect()}
    assert {(k, len(last) + k) for k in range(20)} <= got and len(got) < 4 * len(rows)


def test_words_meet_whenever_one_can_stand_for_the_other(spark):
    r = random.Random(6)
    words = ["imp.ti", "impianti", "manut.", "manutenzioni", "manut", "tornex", "torenx", "tornez", "f.lli", "fratelli", "nino", "antonio", "tonino", "giuse", "serv.", "serv", *sorted(name_variants.SHORT)[:20], *sorted(name_variants.GIVEN)[:20]]
    for n in (3, 4, 5, 6, 9, 28, 29, 30, 31, 32, 60):
        for w in ("".join(r.choices("abcdefghilmnoprstuvz", k=n)) for _ in range(12)):
            i = r.randrange(n - 1)
            words += [w, w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "x" + w[i + 1 :], w[:i] + "xy" + w[i:]]
    words = sorted({w for w in words if len(w) > 1})
    want = {(a, b) for a in words for b in words if max(name_variants.word_similarity(a, b), name_variants.word_similarity(b, a)) >= 0.6}
    got = [tuple(x) for x in name_variants.met_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_candidates_against_all_pairs(spark, scale):
    """Recall of the links of the candidate stage against a comparison of all pairs of nodes of the test table."""
    rows = spark.read.parquet(f"/root/testdata/sf{scale}/allegati_parsed.parquet").select("beneficiario").distinct().collect()
    nodes = {}
    for (n,) in rows:
        words, form, acronym = name_variants.parse(n) if n else ([], "", False)
        if words and not acronym:
            nodes[tuple(sorted(words)), form] = words
    every = list(nodes.items())
    want = set()
    for i, ((_, fa), a) in enumerate(every):
        for (_, fb), b in every[:i]:
            if name_variants.compare(a, b, fa, fb)[0] >= name_variants.SAME:
                want.add(frozenset((tuple(sorted(a)) + (fa,), tuple(sorted(b)) + (fb,))))
    df = spark.createDataFrame([(k, sorted(set(name_variants.distinctive(w))), list(w), f) for k, ((_, f), w) in enumerate(every)], "node bigint, own array<string>, words array<string>, form string")
    df = df.selectExpr("*", "'x' as campo", "xxhash64(own) as head", "false as acronym", "cast(array() as array<string>) as acronyms")
    got = {frozenset(tuple(sorted(every[x][1])) + (every[x][0][1],) for x in r) for r in name_variants.candidates(df).collect()}
    assert len(want & got) >= 0.97 * len(want) > 0


@pytest.fixture(scope="module")
def model():
    return personal.trained()


def items(model, text, places=("Borgo Alto",)):
    out = personal.found([text], *model, {}, list(places))[0]
    return [(k, " ".join(text[a:b].split())) for a, b, k in out]


def test_items_of_a_sentence(model):
    t = "Richiedente Ezio Barmanetti, recapito 305 12 34\n567, posta elettronica e.barmanetti[chiocciola]posta.example, domicilio via dei\nTigli, 3/C - 00123 Borgo\nAlto. La seduta del 12/03/2024 è valida, protocollo n. 1234567."
    assert items(model, t) == [("nome", "Ezio Barmanetti"), ("telefono", "305 12 34 567"), ("email", "e.barmanetti[chiocciola]posta.example"), ("indirizzo", "via dei Tigli, 3/C - 00123 Borgo Alto")]
    assert items(model, "Vista la domanda di BARMANETTI Ezio (C.F. BRM ZEI 60A01 Y111Z) acquisita al protocollo n. 1234567;") == [("nome", "BARMANETTI Ezio"), ("identita", "BRM ZEI 60A01 Y111Z")]
    assert items(model, "La sosta in via dei Tigli è vietata. Codice CIG BRR7FULYG6.") == []
    assert items(model, "BARMANETTI, EZIO") == [("nome", "BARMANETTI, EZIO")] and items(model, "Tornex Impianti S.r.l.") == []


BITS = ["BRMZEI60A01Y111Z", "BRM ZEI 60A01 Y111Z", "brmzei60a01y111z", "AB12345CD", "AA1234567", "xAA1234567", "A A1234567", "305 1234567", "+39 (06) 12.34.567", "0039 305/1234567", "(0835)123456", "/305 1234567", "12/03/2024", "2.305 1234567",
        "via dei Tigli, 3/C - 00123 Borgo\nAlto", "VIA ROMA 1", "v.le Monte 12 bis", "\u017ftrada Vecchia 4", "c.so Italia n. 5", "l'aviavia Roma 3", "p.zza San Carlo 2", "a@b.example", "x.y @ posta.example", "q[at] z.example", "(chiocciola)", "@", "[", "[at", "borgo  alto", "Borgo",
        "BORGO ALTO", "xBorgo Alto", "Ezio Barmanetti", ".", ",", "_", "\u2003", "\n", "\x1f", "", "OGGETTO", "è", "\U0001d7d8", "İ", "ß", "1", "a", "A"]


def test_patterns_are_found_as_by_a_search_from_every_place(model):
    """What begins at the signs and figures looked for is all that the patterns match; types of marked sentences are the same both ways."""
    import re

    types, _ = model
    sign = re.compile(r"\s?(?:@|[\[(](?:chiocciola|at)[\])])\s?", re.I)
    place = re.compile(r"(?<!\w)(?:Borgo\s+Alto|İ\s+a|borgo|ß)(?!\w)", re.I)
    r, seen = random.Random(12), [0] * 5
    for _ in range(4000):
        t = "".join(x + r.choice(["", " ", " ", "  ", "\n"]) for x in r.choices(BITS, k=r.randint(1, 9)))
        mails = []
        for m in sign.finditer(t):
            a, host = m.start(), personal.HOST.match(t, m.end())
            while a and (t[a - 1].isalnum() or t[a - 1] in "_.+-"):
                a -= 1
            mails += [(a, host.end())] if host and a < m.start() else []
        pairs = [
            ([m.span() for m in personal.identities(t)], [m.span() for m in personal.IDENTITY.finditer(t)]), ([m.span() for m in personal.phones(t)], [m.span() for m in personal.PHONE.finditer(t)]),
            ([m.span() for m in personal.addresses(t)], [m.span() for m in personal.ADDRESS.finditer(t)]), ([m.span() for m in personal.any_of(("borgo", "Borgo Alto", "İ a", "ß", " ")).finditer(t)], [m.span() for m in place.finditer(t)]),
            (list(personal.emails(t)), mails),
        ]
        for k, (got, want) in enumerate(pairs):
            assert got == want, t
            seen[k] += len(want)
        hits, h = personal.marks(t, ["Borgo Alto"]), 0
        for at, end in personal.sentences_of(t):
            while h < len(hits) and hits[h][1] <= at:
                h += 1
            if h < len(hits) and hits[h][0] < end:
                tokens = personal.TOKEN.findall(t, at, end)
                assert len(t[at:end].rstrip()) <= sum(map(len, tokens)) <= end - at
                assert types.marked_sequence(t, at, tokens, hits, h, "*" if t.islower() else "") == types.sequence(t, personal.spans_of(t, at, end), hits), t
    assert min(seen) > 100


def test_held_out_accuracy():
    """Trained on the table, tried on sentences with other values."""
    types, field = personal.trained()
    right = every = 0
    for pieces in labelled.table(2, seed=99):
        text = "".join(p for p, _ in pieces)
        want = {(k, " ".join(p.split())) for p, k in pieces if k}
        got = set(items((types, field), text, labelled.PLACES))
        right += len(want & got)
        every += len(want | got)
    assert right / every > 0.93


UNSEEN = "Giacomo Patrizia Massimo Alberto Claudio Riccardo Simone Martina Monica Stefania Daniele Fabrizio Tiziana Mauro Cinzia Ilaria Renzo Loredana Ivano Debora Samuele Noemi Cosimo Ottavio".split()
SURNAMES = "Bertolini Cattaneo Marchetti Pellegrino Sartori Guerra Fontana Silvestri Caruso Longo Santoro Ferraro Vitale Lombardi Moretti Barbieri Rinaldi Colombo De Luca Orsini".replace("De Luca", "Deluca").split()
NEW_SENTENCES = """
Il tutore {n} ha consegnato la delega allo sportello.
Con la presente il sig. {n} chiede il rimborso della tassa.
La commissione è formata da {n}, {n} e {n}.
Il premio va a {n}, nata il 3 maggio 1960.
Si prende atto della rinuncia di {n}, codice fiscale BRTGCM60A01Y111Z.
Avvocato del comune è {n} (C.F. BRTGCM60A01Y111Z).
Per la consegna delle chiavi sentire {n}, tel. 305 1234567.
La sig.ra {n} abita in via dei Tigli 4 e non possiede altri immobili.
Accertato che {n} è residente in piazza della Pace, 12;
Sottoscrivono {n} e {n} per accettazione.
Il verbale è stato letto da {n} e approvato.
Incaricato del collaudo: arch. {n} - cell. 305 7654321.
{n}
{n} tel. 305 7654321
{n} - C.F. BRTGCM60A01Y111Z
{n}, via dei Tigli, 3
dott. {n}
""".strip().split("\n")


def test_held_out_names_in_held_out_sentences(model):
    """Names that stand in no list, in sentences that the table does not have."""
    assert not any(personal.given(g) for g in UNSEEN[:3])
    r, found, want, wrong, lost = random.Random(2), 0, 0, 0, []
    for sentence in NEW_SENTENCES * 12:
        names = []
        while "{n}" in sentence:
            first, last = r.choice(UNSEEN), r.choice(SURNAMES)
            names.append(r.choice([f"{first} {last}", f"{last} {first}", f"{last.upper()} {first}", f"{first} {last}".upper()]))
            sentence = sentence.replace("{n}", names[-1], 1)
        got = [v for k, v in items(model, sentence) if k == "nome"]
        found += len(set(got) & set(names))
        want += len(set(names))
        wrong += len(set(got) - set(names))
    assert found / want >= 0.94 and wrong / want <= 0.06, (found, want, wrong, lost)


def test_the_labelled_sentences_are_not_those_of_the_tables(spark):
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/documenti_corpus.parquet").select("text").filter("text is not null").collect()
    corpus = "\n".join(" ".join(t.split()) for (t,) in rows)
    for line in labelled.SENTENCES.strip().split("\n"):
        fixed = [x for p in re.split(r"\{\w+\}", line) if len(x := p.strip()) > 20]
        assert not fixed or not all(x in corpus for x in fixed), line


def test_items_over_the_edges_of_windows(model):
    t = "la spesa della scuola è di € 12,50 e " * 130 + "per chiarimenti rivolgersi a Ezio Barmanetti, tel. 305 1234567 oppure e.barmanetti@posta.example " + "la spesa della scuola è di € 12,50 e " * 130
    for shift in range(0, 60, 12):
        assert items(model, "si " * shift + t) == [("nome", "Ezio Barmanetti"), ("telefono", "305 1234567"), ("email", "e.barmanetti@posta.example")]


def test_patterns_are_features_only(model):
    """The labels of the field decide: without its weights there is no item, whatever the patterns match."""
    types, field = model
    empty = personal.Field(len(types.types))
    empty.weights = np.zeros_like(field.weights)
    text = "Scrivere a e.barmanetti@posta.example, C.F. BRMZEI60A01Y111Z"
    assert personal.found([text], types, empty, {}, [])[0] == [] and len(items(model, text)) == 2


def test_gradient_matches_differences():
    field = personal.Field(5)
    field.w += np.random.RandomState(1).normal(size=field.w.shape) * 0.3
    field.w[:, :, 2::2] = field.w[:, :, 2::2]
    sentence = ([1, 2, 3, 4], [0, 1, 2, 0])

    def loss():
        x = np.zeros((1, 10), int)
        x[0, 3:7] = sentence[0]
        s, t = field.scores(x)[0], field.t
        gold = t[field.k, 0] + s[0, 0] + sum(t[a, b] + s[i, b] for i, (a, b) in enumerate(zip(sentence[1], sentence[1][1:]), 1))
        a = s[0] + t[field.k]
        for i in range(1, 4):
            m = a[:, None] + t[: field.k]
            a = np.log(np.exp(m - m.max(0)).sum(0)) + m.max(0) + s[i]
        return gold - (np.log(np.exp(a - a.max()).sum()) + a.max())

    dw, dt = np.zeros_like(field.w), np.zeros_like(field.t)
    x, y = np.zeros((1, 10), int), np.array([sentence[1]])
    x[0, 3:7] = sentence[0]
    field._gradient(x, y, np.ones((1, 4), bool), dw, dt)
    for at in ((3, 2, 1), (2, 1, 0), (4, 3, 2)):
        before = loss()
        field.w[at] += 1e-5
        assert abs((loss() - before) / 1e-5 - dw[at]) < 1e-3
        field.w[at] -= 1e-5


def test_rows(spark):
    df = spark.createDataFrame([(1, "Ezio Barmanetti tel. 305 1234567"), (2, None), (3, ""), (4, "Ezio Barmanetti\nEzio  Barmanetti")], "k bigint, t string").selectExpr("*", "1 as items", "2 as text")
    out = {r["k"]: r for r in personal.personal(df, "k", "t").collect()}
    assert out[1]["text"] == "[NOME] tel. [TELEFONO]" and out[2]["text"] is None and out[3]["text"] == ""
    assert personal.personal(df.limit(0), "k", "t").count() == 0
