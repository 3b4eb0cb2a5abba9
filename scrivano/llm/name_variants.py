"""Variant spellings of people, firms and bodies.

1. Each different string is reduced to its words: titles, legal forms and further data (addresses, numbers, mail) are set
   apart; strings with the same words, in any order, are one node.
2. Candidates: in names that `compare` links all words of one have their partner, and two distinctive words (no given names,
   no words of trades) are partners. So each node asks with one distinctive word, that which fewest nodes answer, and all
   nodes answer that have a word which can stand for it. Which words can is found once for each two different words: they
   meet on what is left of them without two letters, words of more than `LONG` letters by MinHash over padded q-grams (the
   number of bands follows from the collision curve 1 - (1 - s^r)^b, so that similarity `SIMILAR` meets with `RECALL`), short
   forms and abbreviations on what they stand for. Names with initials ask with all distinctive words. Nothing is asked for by
   likeness alone, so names that merely look alike cost no comparison. Where a word has more than `FEW` pairs of nodes (a
   surname of very many people) nodes meet by one more word, through keys that words meet on whenever `compare` can match
   them; both ways give the same links. Acronyms meet names through the acronyms that a name can have.
3. Candidates are verified by Monge-Elkan similarity, the mean of the best matches of the shorter name's words, with a
   typing distance inside: Damerau distance in which only keys that lie side by side are one slip. Initials, short forms
   and abbreviations count as the word they stand for. Then the words are matched one to one; if words are left over on
   both sides, or there are more than `EDITS` slips, the names differ. Nothing here depends on how often a word occurs,
   so a link does not go when the data grow.
4. Star clustering: the node with most full links among its neighbours is a centre, the nodes linked to it are its
   satellites; rounds go on until every node is placed. A node whose words fit several centres equally names none of them.

Defined results: null, blank and generic entries ("diversi") give no pair; equal strings are one string.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivano.session import written

Q, ROWS, SIMILAR, RECALL, SAME = 3, 3, 0.3, 0.98, 0.8
EDITS, FEW, LONG = 3, 1000, 30
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - SIMILAR**ROWS))
# What is no part of a name.
TITLES = "dott dr dssa dottssa arch ing geom avv rag sig sigra sigri prof profssa ditta spettle spett impresa gent gentle egr sra on cav mons don".split()
LEGAL = [
    (r"s\.? ?c\.? ?a\.? ?r\.? ?l\.?|soc(?:iet[aà]|\.)? ?coop(?:erativa|\.)?(?: ?a ?r\.? ?l\.?)?(?: sociale)?|coop(?:erativa|\.)?(?: sociale)?", "coop"),
    (r"s\.? ?r\.? ?l\.?s?\.?(?: ?unipersonale)?|societ[aà]'? a responsabilit[aà]'? limitata", "srl"),
    (r"s\.? ?p\.? ?a\.?|societ[aà]'? per azioni", "spa"),
    (r"s\.? ?n\.? ?c\.?|societ[aà]'? in nome collettivo", "snc"),
    (r"s\.? ?a\.? ?s\.?|societ[aà]'? in accomandita semplice", "sas"),
]
FORMS = [(re.compile(rf"(?<![\w.])(?:{p})(?![\w])", re.I), k) for p, k in LEGAL]
FURTHER = re.compile(
    r"\S*@\S*|\S*[\[(](?:at|chiocciola)[\])]\S*|\(.*|\b(?:tel|cell|fax|telefono|cod\. ?fisc|c\. ?f|p\. ?iva|partita iva|iban|mail|pec|e-mail)\b.*"
    r"|[\s,-]+(?:via|viale|v\.le|piazza|p\.zza|piazzale|largo|corso|c\.so|vicolo|vico|contrada|c\.da|strada|località|loc\.|lungolago|borgo|rione)\s+\S.*\d.*|\+?\d[\d\s./-]{4,}.*", re.I)  # fmt: skip
NOBODY = set("diversi diverse vari varie nd na creditori beneficiari fornitori omissis nessuno altri soggetti non disponibile definito applicabile".split())
SMALL = set("di del della dello dei degli delle da la le lo il i e ed per a al in & d l dell".split())
# Italian given names and their short forms.
GIVEN = set(
    "alessandro andrea angela angelo anna annarita antonella antonio bartolomeo carla carlo caterina chiara clelia cristina daniela davide domenica domenico elena elisabetta emanuele "
    "enrico ezio fabio federica filippo francesca francesco fulvio gaetano gian gianluca giorgio giovanna giovanni giulia giuseppe giuseppina grazia guglielmo ines laura lorenzo luca lucia luigi "
    "luisa maddalena marco margherita maria mariagrazia marta matteo michele mario nicola niccolo ornella paola paolo pasquale pier pierpaolo pietro raffaele renato rita roberto rosa rosalia "
    "salvatore sara silvia simona stefano sveva teresa tullio ubaldo valentina vincenzo ugo rosaria carmela".split()
)
SHORT = {
    "pippo": "filippo giuseppe", "nino": "antonio antonino", "tonino": "antonio", "totonno": "antonio", "toni": "antonio", "mimmo": "domenico", "mimma": "domenica", "lino": "pasquale pasqualino angelo",
    "pasqualino": "pasquale", "lena": "maddalena elena", "nella": "antonella ornella", "rina": "caterina", "pina": "giuseppina", "pino": "giuseppe", "peppe": "giuseppe", "beppe": "giuseppe", "tano": "gaetano",
    "franco": "francesco", "franca": "francesca", "cesco": "francesco", "ciccio": "francesco", "lia": "rosalia clelia", "betta": "elisabetta", "lisa": "elisabetta luisa", "elisa": "elisabetta", "memmo": "guglielmo", "memo": "guglielmo", "mino": "guglielmo", "lello": "raffaele", "enzo": "vincenzo lorenzo",
    "sandro": "alessandro", "gigi": "luigi", "gino": "luigi", "luigino": "luigi", "lele": "emanuele", "manuele": "emanuele", "manu": "emanuele", "renzo": "lorenzo", "bortolo": "bartolomeo", "meo": "bartolomeo", "toto": "salvatore", "turi": "salvatore", "salvo": "salvatore",
    "nicolo": "niccolo", "nico": "nicola niccolo", "gianni": "giovanni", "vanni": "giovanni", "rosa": "rosalia", "rita": "margherita", "marga": "margherita", "baldo": "ubaldo", "resi": "teresa", "terry": "teresa", "nora": "ornella eleonora",
    "isa": "elisabetta", "tullietto": "tullio", "cate": "caterina", "cinzia": "caterina", "checco": "francesco", "chicca": "francesca", "dome": "domenico", "menico": "domenico", "lalla": "rosalia", "zino": "vincenzo", "cenzo": "vincenzo",
}
FULL = {f for names in SHORT.values() for f in names.split()}
# Words that many firms have in their names.
TRADES = set(
    "ambientali ambiente arredi assistenza autolinee carpenteria collettiva consulenze costruzioni distribuzione edilizia editrice elettrotecnica energia fornitura forniture impianti industriali "
    "informatica legnami manutenzioni noleggi progettazione pulizie ristorazione scavi scolastiche segnaletica servizi sicurezza sociale stradali termoidraulica trasporti vivai vigilanza software gestioni".split()
)


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def parse(name: str) -> tuple[list[str], str, bool]:
    """Words of a name, its legal form (or ''), and whether it is an acronym."""
    s = FURTHER.sub(" ", re.sub(r"\s+", " ", name.strip()))
    form = ""
    for rx, kind in FORMS:
        s, n = rx.subn(" ", s)
        if n and not form:
            form = kind
    s = plain(s).replace("unipersonale", " ")
    s = re.sub(r"\b((?:[a-z]\.){2,})", lambda m: " " + m[1].replace(".", "") + "§ ", s)
    words, acronym = [], False
    for t in re.findall(r"[a-z0-9§]+(?:\.[a-z]+)*\.?", re.sub(r"['’`]", " ", re.sub(r"(?<=\w)['’](?=\s|$)", "", s))):
        if t.endswith("§"):
            if len(t) > 3:
                acronym = True
                words.append(t[:-1])
            else:
                words += [c for c in t[:-1]]
            continue
        base = t.replace(".", "")
        if base in TITLES or base.isdigit() or base in SMALL and len(base) > 1 or base in ("a", "e", "i") and not t.endswith("."):
            continue
        inside = t.rstrip(".").split(".")
        words.append(f"{inside[0]}.{inside[-1]}" if len(inside) > 1 else base + ("." if t.endswith(".") and 1 < len(base) < 9 else ""))
    if all(w.strip(".") in NOBODY or len(w) == 1 for w in words):
        words = []
    acronym = acronym and len(words) == 1 or len(words) == 1 and 2 < len(words[0]) < 6 and bool(form) and not re.search("[aeiou]", words[0])
    return words, form, acronym


def distinctive(words: list[str]) -> list[str]:
    own = [w for w in words if len(w) > 2 and "." not in w and w not in GIVEN and w not in SHORT and w not in TRADES]
    return own or [w for w in words if len(w) > 1]


def grams(words: list[str]) -> set[str]:
    pad = "#" * (Q - 1)
    return {p[i : i + Q] for w in words for p in [f"{pad}{w}{pad}"] for i in range(len(p) - Q + 1)}


def bands(words: list[str]) -> list[int]:
    """One number for each band; equal numbers make a candidate."""
    g = grams(distinctive(words))
    if not g:
        return []
    x = np.array([zlib.crc32(t.encode()) for t in g], np.uint64)
    r = np.random.RandomState(7)
    a = r.randint(1, 1 << 31, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    b = r.randint(0, 1 << 31, BANDS * ROWS).astype(np.uint64)
    low = (((x[None, :] * a[:, None] + b[:, None]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).min(axis=1).reshape(BANDS, ROWS)
    mix = low[:, 0] * np.uint64(0x100000001B3) ^ low[:, 1] * np.uint64(0x9E3779B1) ^ low[:, 2] * np.uint64(0xC2B2AE3D27D4EB4F) ^ np.arange(BANDS, dtype=np.uint64)
    return (mix >> np.uint64(1)).astype(np.int64).tolist()


def acronyms(words: list[str], acronym: bool) -> list[str]:
    """Acronyms a name can have: its initials, and for short names one more of its letters."""
    if acronym:
        return [words[0]]
    own = [w.rstrip(".") for w in words if len(w) > 2]
    if not 2 <= len(own) <= 7:
        return []
    first = "".join(w[0] for w in own)
    out = {first}
    if len(own) <= 3:
        for k, w in enumerate(own):
            out |= {first[: k + 1] + c + first[k + 1 :] for c in w[1:]}
    return sorted(x for x in out if len(x) > 2)


# Rows of the keyboard; a key lies beside two of the row below.
KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
BESIDE = {(x, y) for row in KEYS for x, y in zip(row, row[1:])} | {(x, y) for up, down in zip(KEYS, KEYS[1:]) for k, x in enumerate(up) for y in down[max(0, k - 1) : k + 1]}
BESIDE |= {(y, x) for x, y in BESIDE}


def distance(a: str, b: str, most: int, other: int = 1) -> int:
    """Damerau distance (optimal alignment), or `most` + 1 if it is larger. `other` is what a letter costs that stands for one whose key is not beside its own."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, now[-1] + 1, one[j - 1] + (0 if x == y else 1 if other == 1 or (x, y) in BESIDE else other))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        two, one = one, now
    return one[-1]


@lru_cache(maxsize=500_000)
def word_similarity(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    x, y = a.strip("."), b.strip(".")
    if x == y:
        return 1.0
    if len(x) == 1:
        return 0.9 if y[0] == x or y in SHORT and any(f[0] == x for f in SHORT[y].split()) else 0.0
    if not set(SHORT.get(x, "").split()).isdisjoint(SHORT.get(y, "").split()):
        return 0.95
    for s, f in ((x, y), (y, x)):
        if s in SHORT and f in SHORT[s].split():
            return 0.95
        if "." in s:
            head, tail = s.split(".")[0], s.split(".")[-1]
            if len(f) > len(head) + len(tail) and f.startswith(head) and f.endswith(tail):
                return 0.95
    if len(x) > 2 and y.startswith(x) and ("." in a + b or y in TRADES or len(x) > 3 and y in GIVEN):
        return 0.95
    n = max(len(x), len(y))
    if n < 4 or x in GIVEN and y in GIVEN or x in TRADES and y in TRADES:
        return 0.0
    most = 1 if n < 6 else 2
    d = distance(x, y, most, other=2)
    return 1 - d / n if d <= most else 0.0


def compare(a: list[str], b: list[str], form_a: str, form_b: str) -> tuple[float, bool]:
    """Monge-Elkan similarity of two names (0 if they differ), and whether each word has its partner."""
    if form_a and form_b and form_a != form_b:
        return 0.0, False
    for k in range(len(a) - 1):
        if len(a) > len(b) and (a[k] + a[k + 1]) in b:
            a = [*a[:k], a[k] + a[k + 1], *a[k + 2 :]]
            break
    for k in range(len(b) - 1):
        if len(b) > len(a) and (b[k] + b[k + 1]) in a:
            b = [*b[:k], b[k] + b[k + 1], *b[k + 2 :]]
            break
    table = [[word_similarity(x, y) for y in b] for x in a]
    best = [max(row) for row in table] if len(a) <= len(b) else [max(column) for column in zip(*table)]
    if sum(best) < SAME * len(best):
        return 0.0, False
    edits = 0
    pairs = sorted(((s, i, j) for i, row in enumerate(table) for j, s in enumerate(row)), reverse=True)
    mine, yours, total, own = set(), set(), 0.0, False
    names = set(distinctive(a)), set(distinctive(b))
    for s, i, j in pairs:
        if s < 0.6:
            break
        if i not in mine and j not in yours:
            mine.add(i)
            yours.add(j)
            total += s
            edits += 0 if s in (0.9, 0.95, 1.0) else round((1 - s) * max(len(a[i]), len(b[j])))
            own = own or a[i] in names[0] and b[j] in names[1] and min(len(a[i]), len(b[j])) > 2
    left, right = [w for i, w in enumerate(a) if i not in mine], [w for j, w in enumerate(b) if j not in yours]
    if not own or edits > EDITS or [w for w in left if len(w) > 1] and [w for w in right if len(w) > 1]:
        return 0.0, False
    if any(len(w) == 1 for w in left) and any(len(w) == 1 for w in right) and not (len(mine) > 1):
        return 0.0, False
    full = form_a == form_b and not any(len(w) > 1 for w in left + right) and not any(min(len(a[i]), len(b[j])) == 1 for s, i, j in pairs if s >= 0.6 and i in mine and j in yours and s == 0.9)
    return total / min(len(a), len(b)), full


def slips(word: str) -> set[str]:
    """Keys that two words share whenever `word_similarity` can call one a slip of the other: what is left of them without
    two letters. Words of more than `LONG` letters, which leave too many, meet by MinHash."""
    far = {f"#{k}" for k in bands([word])} if len(word) > LONG - 2 else set()
    if len(word) > LONG:
        return {word} | far
    out = now = {word}
    for _ in range(1 if len(word) < 6 else 2):
        now = {w[:k] + w[k + 1 :] for w in now for k in range(len(w))}
        out = out | now
    return out | far


def word_keys(words: list[str], asking: bool) -> set[str]:
    """Keys of words: where one name asks, the other can answer, if two of their words can be matched."""
    out = set()
    for w in {*words, *(x + y for x, y in zip(words, words[1:]))}:
        full = w.split(".")[0] if "." in w else w
        if len(w.strip(".")) == 1:
            out.add("i" + w[0])
            continue
        if "." in w.rstrip("."):
            out.add("i" + full[0])
        elif not asking:
            out |= {"i" + x[0] for x in (full, *SHORT.get(full, "").split())}
        if len(full) > 2:
            out.add("p" + full[:3])
        for x in (full, *SHORT.get(full, "").split()):
            out |= {"=" + k for k in slips(x)}
    return out


def fits_acronym(word: str, words: list[str]) -> bool:
    return word in acronyms(words, False)


def met_words(words: DataFrame) -> DataFrame:
    """(w, x): the words that can stand for each other, both ways and each for itself. Words of one letter are left out."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bare = [w.strip(".") for w in pdf["word"]]
            yield pd.DataFrame({
                "word": pdf["word"],
                "alike": [sorted(slips(s) | {"/" + f for f in (s, *SHORT.get(s, "").split()) if s in SHORT or f in FULL}) for s in bare],
                # abbreviations ask for the words they can stand for, words of the lists for those that begin as they do
                "asks": [["d" + s[0] + s[-1]] * ("." in s) + ["p" + s] * ("." in w) + ["q" + s[:k] for k in range(3, len(s) + 1) if "." in w or s in TRADES or s in GIVEN] for w, s in zip(pdf["word"], bare)],
                "answers": [["d" + s[0] + s[-1], "q" + s, *("p" + s[:k] for k in range(3, min(len(s), 9) + 1))] for s in bare],
            })

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[max(word_similarity(w, x), word_similarity(x, w)) >= 0.6 for w, x in zip(pdf["w"], pdf["x"])]]  # dots make it depend on the order

    words = words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")  # few rows, much work each: not to be merged into one task
    keyed = written(words.mapInPandas(keys, "word string, alike array<string>, asks array<string>, answers array<string>"), "words")
    side = lambda n, keys: keyed.select(F.col("word").alias(n), F.explode(keys).alias("k")).select(n, F.xxhash64("k").alias("k"))
    met = side("w", "alike").join(side("x", "alike"), "k").filter("w < x").select("w", "x")
    other = side("w", "asks").join(side("x", "answers"), "k").filter("w != x").select(F.least("w", "x").alias("w"), F.greatest("w", "x").alias("x"))
    alike = written(met.unionByName(other).distinct().mapInPandas(verify, "w string, x string"), "alike")
    return alike.unionByName(alike.select(F.col("x").alias("w"), F.col("w").alias("x"))).unionByName(keyed.select(F.col("word").alias("w"), F.col("word").alias("x")))


def views(nodes: DataFrame) -> DataFrame:
    """(node, campo, joined, words, own, letters): the words of each node as they are and with two neighbours written as one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for node, campo, words in zip(pdf["node"], pdf["campo"], pdf["words"]):
                w = list(words)
                for k, v in [(None, w), *((w[k] + w[k + 1], [*w[:k], w[k] + w[k + 1], *w[k + 2 :]]) for k in range(len(w) - 1))]:
                    rows.append((node, campo, k, [x for x in v if len(x) > 1], sorted(set(distinctive(v))), sorted({x for x in v if len(x) == 1})))
            yield pd.DataFrame(rows, columns=["node", "campo", "joined", "words", "own", "letters"])

    every = written(nodes.select("node", "campo", "words").mapInPandas(run, "node bigint, campo string, joined string, words array<string>, own array<string>, letters array<string>"), "views")
    # a joined word counts only where another name has it
    known = every.filter("joined is null").select("campo", F.explode("words").alias("joined")).distinct()
    return written(every.filter("joined is null").unionByName(every.join(known, ["campo", "joined"], "left_semi").select(every.columns)), "views")


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b) of the nodes to be compared."""
    seen = views(nodes.filter("not acronym"))
    answers = seen.select("campo", "node", "own", F.explode("words").alias("x")).groupBy("campo", "node", "x").agg(F.max(F.array_contains("own", F.col("x"))).alias("own"))
    answers = written(answers, "answers")
    often = answers.groupBy("campo", "x").agg(F.count("*").alias("n"))
    alike = met_words(answers.select(F.col("x").alias("word")).distinct())
    reach = written(alike.join(often, "x"), "reach")  # campo, w, x and the nodes that have x
    cost = reach.groupBy("campo", "w").agg(F.sum("n").alias("cost"))

    # a name asks with the one distinctive word that fewest nodes answer, and if it has initials with all, for what they stand for
    each = seen.select("campo", "node", F.coalesce("joined", F.lit("")).alias("joined"), "words", F.size("own").alias("many"), F.explode("own").alias("w")).join(cost, ["campo", "w"])
    one = each.groupBy("campo", "node", "joined").agg(F.min(F.struct("cost", "w")).alias("m"), F.first("words").alias("words"), F.first("many").alias("many"))
    rest = F.array_except("words", F.array("w"))  # longest first
    one = one.select("campo", "node", F.col("m.w").alias("w"), (F.col("many") == 1).alias("own"), "words").withColumn("rest", F.slice(F.array_sort(rest, lambda x, y: F.length(y) - F.length(x)), 1, 1))
    initials = seen.filter("size(letters) > 0").select("campo", "node", F.explode("own").alias("w"), F.lit(True).alias("own"), F.col("letters").alias("rest"))
    asks = one.select("campo", "node", "w", "own", "rest").unionByName(initials).join(reach, ["campo", "w"])
    asks = written(asks.select("campo", F.col("node").alias("a"), "x", F.col("own").alias("only"), "rest", (F.col("n") * F.col("n") > FEW).alias("many")), "asks")
    answer = answers.select("campo", F.col("node").alias("b"), "x", "own")
    fits = lambda df: df.filter("a != b and (own or not only)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = fits(asks.filter("not many").join(answer, ["campo", "x"]))

    # words of many nodes: one asks with one more of its words, or its initials, the other answers with all; without one it asks for all
    def asking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["k"] = [sorted(word_keys(list(r), True)) if len(r) else ["*"] for r in pdf["rest"]]
            yield pdf[["campo", "a", "x", "only", "k"]]

    def answering(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["k"] = [sorted(word_keys(list(w), False) | {"*"}) for w in pdf["words"]]
            yield pdf[["b", "k"]]

    busy = asks.filter("many")
    asked = busy.mapInPandas(asking, "campo string, a bigint, x string, only boolean, k array<string>").withColumn("k", F.explode("k"))
    told = answer.join(busy.select("campo", "x").distinct(), ["campo", "x"], "left_semi")
    keyed = nodes.select(F.col("node").alias("b"), "words").join(told.select("b").distinct(), "b", "left_semi").mapInPandas(answering, "b bigint, k array<string>")
    told = told.join(keyed, "b").withColumn("k", F.explode("k"))
    asked = fits(asked.join(told, ["campo", "x", "k"]))

    short = nodes.filter("acronym").select("campo", F.col("words")[0].alias("short"), F.col("node").alias("a"))
    named = nodes.select("campo", F.explode("acronyms").alias("short"), F.col("node").alias("b"))
    other = short.join(named, ["campo", "short"]).filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.unionByName(asked).unionByName(other).distinct()


def linked_nodes(nodes: DataFrame) -> DataFrame:
    """Links (a, b, sim, full) between nodes (campo, node, words, orders, acronyms, form, acronym)."""
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("words").alias(f"w{n}"), F.when(F.size("orders") > 1, F.col("orders")).alias(f"o{n}"), F.col("form").alias(f"f{n}"), F.col("acronym").alias(f"q{n}"))
    met = candidates(nodes).join(side("a"), "a").join(side("b"), "b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sims, fulls = [], []
            for wa, wb, oa, ob, fa, fb, qa, qb in zip(*(pdf[c] for c in ("wa", "wb", "oa", "ob", "fa", "fb", "qa", "qb"))):
                wa, wb = list(wa), list(wb)
                if qa != qb:
                    orders = ([wb] if ob is None else ob) if qa else [wa] if oa is None else oa
                    good = any(fits_acronym(wa[0] if qa else wb[0], list(o)) for o in orders) and (not fa or not fb or fa == fb)
                    s, full = (0.85 if good else 0.0), False
                else:
                    s, full = compare(wa, wb, fa, fb)
                sims.append(s)
                fulls.append(full)
            out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "sim": sims, "full": fulls})
            yield out[out["sim"] >= SAME]

    return met.mapInPandas(verify, "a bigint, b bigint, sim double, full boolean")


def stars(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, centre) of every node: star clustering by rounds."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "full"))
    both = written(both, "links")
    degree = both.groupBy("a").agg(F.count_if("full").alias("d"))
    # most full links first; among equals the fuller name, then the smaller number. Partial links do not count: a short
    # form has them to every name it fits
    fuller = (F.size("words") + F.when(F.col("form") != "", 1).otherwise(0)).alias("n")
    rank = nodes.join(degree, F.col("node") == F.col("a"), "left").select("node", F.struct(F.coalesce("d", F.lit(0)).alias("d"), fuller, (-F.col("node")).alias("k")).alias("rank"))
    linked = both.select(F.col("a").alias("node")).distinct()
    done, open_ = rank.join(linked, "node", "left_anti").select("node", F.col("node").alias("centre")), rank.join(linked, "node", "left_semi")
    while True:
        near = both.join(open_.select(F.col("node").alias("a"), F.col("rank").alias("ra")), "a").join(open_.select(F.col("node").alias("b"), F.col("rank").alias("rb")), "b")
        beaten = near.filter("rb > ra").select(F.col("a").alias("node")).distinct()
        centres = open_.join(beaten, "node", "left_anti").select("node")
        fits = near.join(centres.select(F.col("node").alias("b")), "b", "left_semi").join(centres.select(F.col("node").alias("a")), "a", "left_anti")
        # a node that fits several centres equally well stays alone
        kind = F.struct("full", F.round("sim", 3).alias("sim"))
        best = fits.select("a", "b", kind.alias("kind")).groupBy("a", "kind").agg(F.min("b").alias("b"), F.count("*").alias("n"))
        best = best.groupBy("a").agg(F.max(F.struct("kind", "b", "n")).alias("m"))
        placed = best.select(F.col("a").alias("node"), F.when(F.col("m.n") == 1, F.col("m.b")).otherwise(F.col("a")).alias("centre"))
        placed = placed.unionByName(centres.select("node", F.col("node").alias("centre")))
        now = written(open_.join(placed, "node", "left"), "stars")
        done, open_ = done.unionByName(now.filter("centre is not null").select("node", "centre")), now.filter("centre is null").select("node", "rank")
        if open_.isEmpty():
            return done


def variants(names: DataFrame) -> DataFrame:
    """Entities (campo, nome, entity) of the different names (campo, nome)."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = [parse(n) for n in pdf["nome"]]
            pdf["words"], pdf["form"], pdf["acronym"] = [x[0] for x in p], [x[1] for x in p], [x[2] for x in p]
            pdf["acronyms"] = [acronyms(x[0], x[2]) for x in p]
            yield pdf

    names = names.filter("nome is not null").distinct()
    kinds = "campo string, nome string, words array<string>, form string, acronym boolean, acronyms array<string>"
    parsed = names.mapInPandas(words, kinds).filter("size(words) > 0")
    parsed = written(parsed.withColumn("node", F.xxhash64("campo", F.array_sort("words"), "form")), "names")
    nodes = parsed.groupBy("node").agg(
        F.first("campo").alias("campo"), F.min("words").alias("words"), F.collect_set("words").alias("orders"), F.first("form").alias("form"),
        F.max("acronym").alias("acronym"), F.array_distinct(F.flatten(F.collect_set("acronyms"))).alias("acronyms"),
    )
    nodes = written(nodes, "nodes")
    placed = stars(nodes, linked_nodes(nodes))
    return parsed.select("campo", "nome", "node").join(placed, "node").select("campo", "nome", F.col("centre").alias("entity"))


def variant_pairs(names: DataFrame) -> DataFrame:
    """(campo, nome_a, nome_b): every pair of spellings of one entity."""
    e = written(variants(names), "entities")
    return e.alias("x").join(e.alias("y"), F.expr("x.campo = y.campo and x.entity = y.entity and x.nome < y.nome")).select("x.campo", F.col("x.nome").alias("nome_a"), F.col("y.nome").alias("nome_b"))
