"""Kind and category of documents by rules over names and texts."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivano.functions.dates import infer_date, infer_number
from scrivano.functions.text import col

# Words in file names and in the first 2500 characters that tell the kind; the first rule that fits counts.
NAME_RULES = [
    ("VistoContabile", ("vistocontabile", "visto_contabile")), ("AttestazionePubblicazione", ("attestazionepubblicazione", "certificatopubblicazione")), ("Elenco", ("elencoelettori", "elenco_", "_elenco")),
    ("Ordinanza", ("ordinanza", "ordinanzesindacali")), ("Decreto", ("decreto", "decretosindacale")), ("Determinazione", ("determina", "determinazione")), ("Delibera", ("delibera", "deliberazione")), ("Bando", ("bando",)), ("Avviso", ("avviso",)),
]
HEAD_RULES = [
    ("VistoContabile", ("visto di regolarità contabile", "visto di regolarita contabile")), ("AttestazionePubblicazione", ("certificato di pubblicazione", "attestazione di pubblicazione")), ("Elenco", ("elenco dei cittadini", "elenco elettori")),
    ("Ordinanza", ("ordinanza sindacale", "ordinanza n.")), ("Decreto", ("decreto sindacale", "decreto n.")), ("Determinazione", ("determina", "determinazione")), ("Delibera", ("delibera", "deliberazione")), ("Bando", ("bando",)), ("Avviso", ("avviso",)),
]
TITLE_RULES = [("Determinazione", ("determina",)), ("Delibera", ("delibera",)), ("Ordinanza", ("ordinanza",)), ("Avviso", ("avviso",)), ("Bando", ("bando",))]
# Words of each category and subcategory.
CATEGORIES = {
    "Pubblicazione e Trasparenza": ["certificato di pubblicazione", "attestazione pubblicazione", "responsabile delle pubblicazioni", "albo pretorio"],
    "Lavori Pubblici": ["lavori pubblici", "progetto esecutivo", "completamento", "manutenzione straordinaria", "opera pubblica", "cantiere"],
    "Personale": ["personale", "assunzioni", "concorso", "selezione", "progressione verticale", "interpello", "trattenimento in servizio", "fabbisogno di personale", "dotazione organica"],
    "Contabilità": ["regolarità contabile", "visto contabile", "impegno di spesa", "liquidazione", "pagamento", "fattura", "capitolo", "accertamento", "residui", "salvaguardia equilibri", "fondo garanzia debiti commerciali", "pagoPA", "pos"],
    "Contenzioso": ["contenzioso", "incarico legale", "patrocinio", "corte di giustizia", "tribunale", "ricorso"],
    "Urbanistica": ["urbanistica", "piano di sviluppo", "recupero urbano", "permesso di costruire", "edilizia"],
    "Servizi Sociali": ["servizi sociali", "assistenza", "contributo economico", "indennità"],
    "Cultura e Turismo": ["cultura", "turismo", "manifestazione", "evento", "spettacolo"],
    "Ambiente": ["ambiente", "ecologia", "rifiuti", "inquinamento"],
    "Commercio": ["commercio", "suap", "attività produttive"],
    "Regolamenti": ["regolamento", "approvazione", "modifica"],
    "Affari Generali": ["affari generali", "protocollo", "archivio", "statuto"],
    "Servizi Demografici": ["servizi demografici", "anagrafe", "stato civile", "elettorale"],
}
SUBCATEGORIES = {
    "Approvazione Progetto": ["approvazione progetto"], "Liquidazione": ["liquidazione", "pagamento", "saldo"], "Affidamento Incarico": ["affidamento incarico", "conferimento incarico"], "Bando": ["bando", "avviso pubblico"],
    "Concorso": ["concorso", "selezione"], "Progressione Verticale": ["progressione verticale", "selezione interna"], "Riaccertamento Residui": ["riaccertamento residui"], "Variazione di Bilancio": ["variazione di bilancio"], "Nomina": ["nomina", "costituzione"],
}
SUBJECT_WEIGHT, TEXT_PREFIX = 4, 3500


def by_rules(text: Column, rules: list[tuple[str, tuple[str, ...]]]) -> Column:
    """Label of the first rule one of whose words is in the text, or null."""
    return F.coalesce(*(F.when(F.lower(text).rlike("|".join(map(re.escape, words))), label) for label, words in rules))


def document_kind(name: str | Column, text: str | Column) -> Column:
    head = F.substring(F.coalesce(col(text), F.lit("")), 1, 2500)
    return F.coalesce(by_rules(F.coalesce(col(name), F.lit("")), NAME_RULES), by_rules(head, HEAD_RULES), F.lit("unknown"))


def title_kind(text: str | Column) -> Column:
    return by_rules(F.coalesce(col(text), F.lit("")), TITLE_RULES)


def has_word(text: Column, low: Column, word: str) -> Column:
    """Whether the word or phrase stands in the text, by itself, in any case. `low` is the text in lower case: a plain
    search in it rules out most rows before the pattern is tried."""
    return low.contains(word.lower()) & text.rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}_]){re.escape(word)}(?![\p{{L}}\p{{N}}_])")


def scores(subject: Column, subject_low: Column, head: Column, head_low: Column) -> Column:
    """Array of (category, score, terms) with a score above 0. Rules are literals, so each pattern is compiled once a task."""
    out = []
    for name, words in CATEGORIES.items():
        hits = F.array(*(F.struct(F.lit(w).alias("w"), (has_word(subject, subject_low, w).cast("int") * SUBJECT_WEIGHT + has_word(head, head_low, w).cast("int")).alias("s")) for w in words))
        out.append(F.struct(F.lit(name).alias("category"), hits.alias("hits")))
    ranked = F.transform(
        F.array(*out),
        lambda c: F.struct((-F.aggregate(c["hits"], F.lit(0), lambda a, x: a + x["s"])).alias("k"), c["category"].alias("category"), F.array_sort(F.transform(F.filter(c["hits"], lambda x: x["s"] > 0), lambda x: x["w"])).alias("terms")),
    )
    return F.array_sort(F.filter(ranked, lambda x: x["k"] < 0))


def classified(docs: DataFrame, subject: str = "oggetto", text: str = "text") -> DataFrame:
    """Adds category (best score, ties by name), confidence (`high`, or `ambiguous` on a tie at the top), terms and subcategory."""
    full = lambda c: F.coalesce(F.col(c), F.lit(""))
    df = docs.withColumns({"_s": full(subject), "_h": F.substring(full(text), 1, TEXT_PREFIX), "_b": F.concat(full(subject), F.lit(" "), full(text))})
    df = df.withColumns({f"{c}l": F.lower(c) for c in ("_s", "_h", "_b")})
    any_of = lambda words: functools.reduce(lambda a, b: a | b, (has_word(F.col("_b"), F.col("_bl"), w) for w in words))
    sub = F.coalesce(*(F.when(any_of(words), label) for label, words in SUBCATEGORIES.items()))
    df = df.withColumn("_all", scores(F.col("_s"), F.col("_sl"), F.col("_h"), F.col("_hl")))
    first, second = F.try_element_at("_all", F.lit(1)), F.try_element_at("_all", F.lit(2))
    tie = F.coalesce(first["k"] == second["k"], F.lit(False))
    confidence = F.when(first.isNotNull(), F.when(tie, "ambiguous").otherwise("high"))
    new = {"category": first["category"], "subcategory": sub, "classification_confidence": confidence, "classification_terms": F.nullif(F.concat_ws(",", first["terms"]), F.lit(""))}
    return df.withColumns(new).drop("_all", "_s", "_h", "_b", "_sl", "_hl", "_bl")


def enriched(items: DataFrame) -> DataFrame:
    """Missing kind, number and date of a notice from its title and subject; a useless title from the subject."""
    text = F.concat_ws(" ", F.coalesce("titolo", F.lit("")), F.coalesce("oggetto", F.lit("")))
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return items.withColumns(
        {
            "tipologia": F.coalesce(blank("tipologia"), title_kind(text)),
            "numero": F.coalesce(blank("numero"), infer_number(text)),
            "data_pubblicazione": F.coalesce(blank("data_pubblicazione"), infer_date(text)),
            "titolo": F.when(F.lower(F.trim(F.coalesce("titolo", F.lit("")))).isin("", "vai"), F.substring(F.coalesce("oggetto", F.lit("")), 1, 180)).otherwise(F.col("titolo")),
        }
    )


# Kinds that are never or always about money, and words (also inside other words) that tell it.
NO_MONEY = ("Ordinanza", "Decreto", "Elenco", "AttestazionePubblicazione")
MONEY_WORDS = (
    "liquidazione", "impegno di spesa", "determina di impegno", "determina di liquidazione", "cig", "cup", "fattura", "fornitore", "pagamento", "capitolo", "accertamento", "visto contabile", "regolarità contabile",
    "regolarita contabile", "spesa complessiva", "quadro economico", "importo contrattuale",
)
WORK_WORDS = ("servizio", "lavori", "fornitura")


def about_money(text: str | Column, kind: str | Column, category: str | Column) -> Column:
    t, k = F.lower(F.coalesce(col(text), F.lit(""))), F.coalesce(col(kind), F.lit(""))
    any_of = lambda ws: t.rlike("|".join(map(re.escape, ws)))
    return (
        F.when(k.isin(*NO_MONEY), False).when(k == "VistoContabile", True).when(any_of(MONEY_WORDS), True)
        .when((F.coalesce(col(category), F.lit("")) == "Contabilità") & (k == "Determinazione"), True).when((k == "Determinazione") & any_of(WORK_WORDS), True).otherwise(False)
    )
