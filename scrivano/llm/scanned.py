"""Noise of scanned pages: running headers, page numbers, words broken at line ends and misread characters.

1. One scan splits the texts into words and lines. The words of the whole corpus are counted in Spark; the count table is
   written once and stays a table, whatever its size.
2. The lay-out of each text is read: page numbers are lines of one form whose numbers rise through the text, headers are
   lines at page edges that come back almost alike, or that repeat the end of the act's title, and a line that ends in a
   break goes on in the next line of the running text. What the decisions need to know (is the joined word known, or the
   hyphenated one?) is asked of the count table by a join.
3. A misread word and the right one have the same shape: the strokes of their letters, in which look-alikes are equal.
   Words are joined to far more frequent words of their shape, and a pair counts if look-alike characters lead from one to
   the other. The test is a ratio of two counts, so it does not move with the size of the corpus.
4. The answers come back to their texts by a join, and each text is repaired. A hyphen at a line's end stays if the corpus
   knows the hyphenated word better than the joined one.

Defined results: null and empty texts have no cases and stay as they are; lines that the site adds (`repeated_lines`) are
never cases and are left out of the running text; ties between right words go to the smaller by code point.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivano.llm.repeated_lines import lines_of_blocks, with_lines
from scrivano.session import written

TIMES_MORE, MOST_REPLACED, SHORTEST_PAGE, PAGES_IN_ROW = 40, 3, 6, 3
BREAKS = "-­¬￾‐"
# What a recogniser reads, and what stood there.
MISREAD = {
    "0": ["o"], "1": ["i", "l"], "5": ["s"], "à": ["a"], "c": ["e"], "f": ["t"], "e": ["c"], "n": ["u", "ri"], "q": ["g"], "b": ["h"],
    "m": ["rn", "in"], "rn": ["m"], "w": ["vv"], "d": ["cl"], "cl": ["d"], "ü": ["ti"], "ì": ["i"], "h": ["li"], "u": ["n", "ii"], "6": ["b"], "8": ["b"], "9": ["g"],
}
# Strokes of letters that are read for one another, each pair of `MISREAD` alike.
STROKES = str.maketrans({
    "0": "o", "1": "i", "l": "i", "ì": "i", "r": "i", "n": "ii", "u": "ii", "h": "ii", "b": "ii", "6": "ii", "8": "ii", "m": "iii", "w": "vv", "e": "c", "d": "ci",
    "f": "t", "ü": "ti", "5": "s", "à": "a", "q": "g", "9": "g",
})
FIGURES = {"O": "0", "o": "0", "l": "1", "I": "1", "S": "5", "Z": "2", "b": "6", "g": "9", "B": "8"}
WORD = re.compile(r"[^\W_]+")
BROKEN = re.compile(rf"([^\W_]+)([{BREAKS}])$")
FIGURE = re.compile(r"(?<![^\W_])(?=[^\W_]*\d)[\dOoSZlbgBI]+(?![^\W_])")
STREET = re.compile(r"(?i)\b(?:via|viale|v\.le|piazza|p\.zza|largo|corso|vicolo|contrada)\s[^.;:]{2,40}$")
NUMBERED = re.compile(r"(?i)^(?P<head>.{4,100}?)\s+(?:[-–—|/·•]\s*(?:(?:pag(?:ina|\.)?|p\.)\s*)?|(?:pag(?:ina|\.)|p\.)\s*)(?P<n>\d{1,4})$")
FORMATS = [
    re.compile(p, re.I)
    for p in (r"[-–—] (\d{1,4}) [-–—]", r"pagina (\d{1,4})", r"pag\.\s?(\d{1,4})", r"pag\. (\d{1,4}) di \d{1,4}", r"p\. (\d{1,4})", r"\[(\d{1,4})\]", r"(\d{1,3})/\d{1,3}", r"(\d{1,3})")
]
PREFIX = re.compile(r"(?i)^(?:comune di .{2,40}? - |\w+ \d+/\d{4} - )")
SAME = str.maketrans({"0": "o", "1": "i", "l": "i", "5": "s", "à": "a", "c": "e", "f": "t", "q": "g", "b": "h", "ì": "i"})


def folded(text: str) -> str:
    """Form in which a misread line equals the right one in most cases."""
    t = " ".join(WORD.findall(text.lower())).translate(SAME)
    return t.replace("ci", "d").replace("vv", "w").replace("rn", "m").replace("ri", "n").replace("in", "m").replace("u", "n")


def alike(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 3 or min(len(a), len(b)) <= 7:
        return False
    m = SequenceMatcher(None, a, b, autojunk=False)
    return m.quick_ratio() >= 0.86 and m.ratio() >= 0.86  # the first is a bound that costs little


def page_numbers(lines: list[str], site: set[int]) -> set[int]:
    """Lines that are page numbers: of one format, with numbers that rise from page to page."""
    best: list[tuple[int, int]] = []
    last = max((i for i, s in enumerate(lines) if s and i not in site), default=0)
    for k, f in enumerate(FORMATS):
        found = [(i, int(m[1])) for i, s in enumerate(lines) if i not in site and (m := f.fullmatch(s))]
        chain: list[tuple[int, int]] = []
        if k < len(FORMATS) - 2:
            for i, n in found:
                if not chain or n > chain[-1][1]:
                    chain.append((i, n))
        else:
            for start in [x for x in found if x[1] == 1]:
                own = [start]
                for i, n in found:
                    if i > own[-1][0] and own[-1][1] < n <= own[-1][1] + 2 and (len(own) < 2 or n > own[-1][1] + 1 or i - own[-1][0] <= own[1][0] - own[0][0] + 3):
                        own.append((i, n))
                if (start[0] <= 1 or own[-1][0] >= last - (k < len(FORMATS) - 1)) and len(own) > len(chain):
                    chain = own
        if len(chain) > len(best):
            best = chain
    return {i for i, _ in best} or unknown_page_numbers(lines, site)


def unknown_page_numbers(lines: list[str], site: set[int]) -> set[int]:
    """Page numbers in a form that is not listed: short lines that differ in one number only, which rises by one from page to
    page, at least `PAGES_IN_ROW` times, with about as many lines between any two."""
    forms: dict[str, list[tuple[int, int]]] = {}
    for i, s in enumerate(lines):
        if i not in site and len(s) < 24 and (m := re.fullmatch(r"(\D*)(\d{1,4})(\D*)", s)):
            forms.setdefault(m[1] + "#" + m[3], []).append((i, int(m[2])))
    for own in forms.values():
        gaps = [j - i for (i, _), (j, _) in zip(own, own[1:])]
        if len(own) >= PAGES_IN_ROW and all(b == a + 1 for (_, a), (_, b) in zip(own, own[1:])) and min(gaps) >= SHORTEST_PAGE and max(gaps) - min(gaps) <= 2:
            return {i for i, _ in own}
    return set()


def headers(lines: list[str], site: set[int], pages: set[int], title: str) -> tuple[set[int], set[int]]:
    """Lines that are running headers, and those of them that end in a page number."""
    own = [(i, s) for i, s in enumerate(lines) if s and i not in site and i not in pages and len(s) < 140]
    place = {i: k for k, (i, _) in enumerate(own)}
    words = title.split()
    tails = {folded(" ".join(words[-k:])) for k in range(4, 9)} | ({folded(title)} if len(words) < 9 else set())
    tails = {t for t in tails if len(t) > 9}
    longest = max(tails, key=len, default="")
    found, numbered = set(), set()
    region = folded(" ".join(s.rstrip(BREAKS) for _, s in own[1:7])).replace(" ", "") if not words else ""
    cores = {}
    for i, s in own:
        m = NUMBERED.match(s)
        bare = PREFIX.sub("", m["head"] if m else s)
        cores[i] = (bool(m), bool(m) or bare != s, bare, folded(bare))
    last: dict[str, int] = {}
    gaps: Counter[str] = Counter()
    for i, (_, _, _, core) in cores.items():
        gaps[core] += i - last.get(core, -SHORTEST_PAGE) < SHORTEST_PAGE
        last[core] = i
    close = {core for core, n in gaps.items() if n > 1}  # lines that keep coming back within a few lines are no page edges
    for k, (i, s) in enumerate(own):
        m, marked, bare, core = cores[i]
        if len(core) < 10 or not marked and core in close and len(words) != len(bare.split()):
            continue
        hit = any(alike(core, t) for t in tails) or k == 0 and not words and len(bare.split()) < 8 and core.replace(" ", "") in region
        if not hit and marked and len(core.split()) > 2 and any(alike(core, t[: len(core)]) and abs(len(t) - len(core)) < 0.6 * len(t) for t in tails):
            hit = True  # its last words are cut off
        if hit and not marked and s.endswith((".", ",", ";", ":", *BREAKS)):
            continue
        if hit and not words:
            tails.add(core)
        if hit and not marked and words:
            # the last line of the title itself, wrapped just there, follows the words before its end
            before = folded(" ".join(words[: -len(bare.split())])).split()[-2:]
            previous = folded(own[k - 1][1]).split()[-len(before) :] if k else []
            left, right = BROKEN.search(own[k - 1][1]) if k else None, WORD.match(s)
            if left and right and folded(left[1] + right[0]) in {folded(x) for w in words for x in WORD.findall(w)}:
                continue  # it begins with the rest of a word of the title
            whole = alike(core, folded(title)) and k + 1 < len(own)
            follows = before and SequenceMatcher(None, "".join(before), "".join(previous), autojunk=False).ratio() > 0.75
            if follows or whole and not any(alike(core, folded(x)) for _, x in own[k + 1 : k + 4]):
                hit = False
        if hit:
            found.add(i)
            if m:
                numbered.add(i)
    # marked lines that come back with the same words, and lines like those already found
    same = Counter(core for m, marked, _, core in cores.values() if marked and len(core) > 9)
    spread = {i for i, (_, marked, _, core) in cores.items() if same[core] > 1 or longest and marked and len(core) > 9 and any(alike(core, cores[j][3]) for j in found)}
    for i in spread:
        m, marked, bare, core = cores[i]
        if marked and (m or len(bare.split()) <= 8 and not bare.endswith((".", ";"))):
            found.add(i)
            if m:
                numbered.add(i)
    # lines at page edges that come back almost alike, whatever they say
    edges = sorted({j for p in pages for j in (p - 1, p + 1)} | {i for i, _ in own[:1]})
    near = [j for j in edges if j in place and j not in found]
    forms = {j: folded(PREFIX.sub("", re.sub(r"\d+", "", lines[j]))) for j in near}
    for j in near:
        here = sum(alike(forms[j], forms[x]) for x in near)
        if len(forms[j]) > 9 and here >= max(2, len(pages) // 2) and cores[j][3] not in close:
            found.add(j)
    return found, numbered


def replaced(wrong: str, right: str, most: int = MOST_REPLACED) -> int | None:
    """How many look-alikes lead from one word to the other; None if more than `most` or none do."""
    best = {(0, 0): 0}
    now = [(0, 0)]
    while now:
        after = []
        for i, j in now:
            n = best[i, j]
            while i < len(wrong) and j < len(right) and wrong[i] == right[j]:
                i, j = i + 1, j + 1
            for a, b, more in _steps(wrong, right, i, j):
                if n + more <= most and best.get((a, b), most + 1) > n + more:
                    best[a, b] = n + more
                    after.append((a, b))
            if i == len(wrong) and j == len(right):
                best[i, j] = min(n, best.get((i, j), most))
        now = after
    return best.get((len(wrong), len(right))) or None


def _chains(most: int = 2) -> dict[str, dict[str, int]]:
    """What one or two characters can stand for after one or two look-alikes ("el" for "cl" for "d"), and how many it takes."""
    letters = sorted({c for w, rights in MISREAD.items() for c in w + "".join(rights)})
    out = {}
    for start in [*letters, *(a + b for a in letters for b in letters)]:
        seen, now = {start: 0}, [start]
        for n in range(1, most + 1):
            now = [x[:i] + r + x[i + len(w) :] for x in now for w, rights in MISREAD.items() for i in range(len(x)) if x.startswith(w, i) for r in rights]
            for x in now:
                seen.setdefault(x, n)
        out[start] = {x: n for x, n in seen.items() if x[0] != start[0]}  # others begin a character later
    return out


CHAINS = _chains()


def _steps(wrong: str, right: str, i: int, j: int) -> list[tuple[int, int, int]]:
    return [(i + k, j + len(r), n) for k in (1, 2) if i + k <= len(wrong) for r, n in CHAINS.get(wrong[i : i + k], {}).items() if right.startswith(r, j)]


@lru_cache(maxsize=100_000)
def _figure(word: str) -> bool:
    return len(word) > 1 and not word.isdigit() and FIGURE.fullmatch(word) is not None


def cased(right: str, word: str) -> str:
    letters = [c for c in word if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return right.upper()
    return right[:1].upper() + right[1:] if word[:1].isupper() else right


def layout(text: str, site: set[int], title: str) -> tuple[list[int], list[int], list[int], list[tuple[int, int, str, str, str]]]:
    """Lines (from 0) that are page numbers, headers, and headers that end in a page number; and the breaks: line, next line
    of the running text, the two parts of the word and the sign between."""
    lines = [s.strip() for s in text.split("\n")]
    pages = page_numbers(lines, site)
    heads, numbered = headers(lines, site, pages, title)
    running = [i for i, s in enumerate(lines) if s and i not in site and i not in pages and i not in heads]
    breaks = []
    for i, j in zip(running, running[1:]):
        if lines[i][-1] in BREAKS and (m := BROKEN.search(lines[i])) and (n := WORD.match(lines[j])):
            if n[0][0].islower() or n[0][0].isdigit() or m[1].isupper() and n[0][0].isupper():
                breaks.append((i, j, m[1], n[0], m[2]))
    return sorted(pages), sorted(heads), sorted(numbered), breaks


def asked(breaks: list[tuple[int, int, str, str, str]]) -> list[str]:
    """What has to be known of the words of the corpus to decide on breaks."""
    return sorted({w.lower() for _, _, left, right, _ in breaks for w in (left + right, f"{left}-{right}")})


def examine(text: str, site: set[int], found: tuple, counts: dict[str, int], rights: dict[str, tuple[str, int]]) -> tuple[list[tuple[int, str]], str]:
    """Cases (line from 0, kind) and the text in whole paragraphs, from the lay-out, the counts of the words asked for and the
    right words (with their counts) of misread ones."""
    pages, heads, numbered, breaks = found
    lines = [s.strip() for s in text.split("\n")]
    cases = [(i, "pagina") for i in {*pages, *numbered}] + [(i, "testatina") for i in heads]
    noise = {*pages, *heads, *site}
    running = [i for i, s in enumerate(lines) if s and i not in noise]
    out = {i: lines[i] for i in [*running, *heads]}
    misread, joined = set(), {}

    # tokens that may have to change; most texts have few
    odd = {w for w in set(WORD.findall(text)) if w.lower() in rights and (len(w) > 1 or w == "c") or _figure(w)}

    for i, j, left, right, sign in breaks:
        whole, kept = (left + right).lower(), f"{left}-{right}".lower()
        one = rights[whole][1] if whole in rights else counts.get(whole, 0)
        two, sides = counts.get(kept, 0), None
        if kept in rights:
            sides, two = rights[kept][0].split("-"), rights[kept][1]
        if sign == "-" and (two > one or not one and (left.isdigit() or right.isdigit())):
            if sides:
                misread |= {x for x, was, now in ((i, left, sides[0]), (j, right, sides[1])) if was.lower() != now}
                left, right = (cased(now, was) if was.lower() != now else was for was, now in zip((left, right), sides))
            joined[i] = (j, f"{left}-{right}")
            continue
        cases.append((i, "sillabazione"))
        joined[i] = (j, left + right)
        if whole in rights:
            to = rights[whole][0]
            ops = [o for o in SequenceMatcher(None, whole, to, autojunk=False).get_opcodes() if o[0] != "equal"]
            misread |= {i if o[1] < len(left) else j for o in ops}
            joined[i] = (j, cased(to, left))
    first_of = {j for j, _ in joined.values()}
    for i in out:
        s = lines[i]
        if not odd or odd.isdisjoint(WORD.findall(s)):
            continue
        spans = [x.span() for x in WORD.finditer(s)]
        skip = {spans[0][0]} if i in first_of and spans else set()
        if i in joined and spans:
            skip.add(spans[-1][0])

        def repair(m: re.Match, i: int = i, s: str = s, skip: set[int] = skip) -> str:
            w = m[0]
            if w not in odd or m.start() in skip:
                return w
            around = s[max(0, m.start() - 1) : m.start()] + s[m.end() : m.end() + 1]
            if "@" in around or "_" in around or w == "c" and around not in (" ", "  "):
                return w
            if _figure(w):
                # a letter after a house number is no misread figure
                if len(w) > 1 and not (w[:-1].isdigit() and w[-1] in "bgBI" and STREET.search(s[: m.start()])):
                    to = "".join(FIGURES.get(c, c) for c in w)
                    misread.add(i)
                    return to
                return w
            if w.isupper() and (len(w) < 4 or len(w) > 8 and any(c.isdigit() for c in w)):
                return w
            if w.lower() in rights:
                misread.add(i)
                return cased(rights[w.lower()][0], w)
            return w

        out[i] = WORD.sub(repair, s)
    cases += [(i, "carattere") for i in misread]
    pieces, glue = [], ""
    for i in running:
        s = out[i]
        if glue:
            s = s[len(WORD.match(s)[0]) :]
        if i in joined:
            s, glue = s[: BROKEN.search(lines[i]).start() - len(lines[i]) or None] + joined[i][1], "x"
            pieces.append((s, True))
        else:
            glue = ""
            pieces.append((s, False))
    done, begun = "", False
    for k, (s, on) in enumerate(pieces):
        done += ("" if not begun or k and pieces[k - 1][1] else _gap(done, s)) + s
        begun = True
    return cases, done


def _gap(before: str, after: str) -> str:
    """A new paragraph where the line before ends a sentence, else a blank."""
    return "\n" if before.endswith((".", ";", ":")) and after[:1].isupper() or re.match(r"\d+\)|€", after) or after.isupper() else " "


def words_of(text: str | Column) -> Column:
    """Words of a text in lower case; of a hyphenated word itself and its parts."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"), F.lit(0))
    return F.flatten(F.transform(tokens, lambda t: F.when(F.contains(t, F.lit("-")), F.concat(F.array(t), F.split(t, "-"))).otherwise(F.array(t))))


def right_words(counts: DataFrame, asked_words: DataFrame) -> DataFrame:
    """(w, right, n) of the misread words among those of the corpus (w, n) and those asked for: the right word and its count."""

    @F.pandas_udf("string")
    def shape(words: pd.Series) -> pd.Series:
        return words.str.translate(STROKES)

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["k"] = [replaced(w, r) for w, r in zip(pdf["w"], pdf["right"])]
            yield pdf[pdf["k"].notna()].astype({"k": "int32"})

    every = counts.unionByName(asked_words.select("w", F.lit(0).cast("bigint").alias("n"))).groupBy("w").agg(F.sum("n").alias("n"))
    every = every.filter(F.col("w").rlike(r"[^\p{N}]")).withColumn("shape", shape("w"))
    wrong = every.select("w", "shape", F.greatest("n", F.lit(1)).alias("have"))
    right = every.filter(F.col("n") >= TIMES_MORE).select(F.col("w").alias("right"), "shape", "n")
    pairs = wrong.join(right, "shape").filter((F.col("n") >= F.col("have") * TIMES_MORE) & (F.col("w") != F.col("right")))
    pairs = pairs.select("w", "right", "n").mapInPandas(checked, "w string, right string, n bigint, k int")
    # a further look-alike must be worth as much as the first: the word it leads to is as many times more frequent
    worth = F.col("n") / F.pow(F.lit(TIMES_MORE), F.col("k") - 1)
    best = pairs.groupBy("w").agg(F.min(F.struct((-worth).alias("worth"), "right", "n")).alias("m"))
    return best.select("w", "m.right", "m.n")


BREAK = "array<struct<i: int, j: int, left: string, right: string, sign: string>>"


def scanned(docs: DataFrame, key: str = "doc_key", text: str = "text", source: str = "ente", title: str = "oggetto") -> DataFrame:
    """(`key`, cases array of (riga, tipo), text): damage by line, and the text in whole paragraphs."""
    docs = written(docs.select(F.col(key).alias("_key"), *with_lines(text, source), F.col(text).alias("text"), F.col(title).alias("title"), words_of(text).alias("words")), "scanned")
    counts = written(docs.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")), "counts")
    gone = lines_of_blocks(docs.select("src", "lines")).groupBy("src").agg(F.collect_set("id").alias("gone"))
    rows = docs.select("_key", "src", "text", "title", "lines").join(gone, "src", "left")
    site = F.transform(F.filter("lines", lambda x: x["wordy"] & F.array_contains("gone", x["id"])), lambda x: x["at"])
    rows = rows.select("_key", "text", "title", F.when(F.col("gone").isNotNull(), site).alias("site"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [layout(t, set() if s is None else set(s), o or "") if t and t.strip() else ([], [], [], []) for t, s, o in zip(pdf["text"], pdf["site"], pdf["title"])]
            pdf["pages"], pdf["heads"], pdf["numbered"] = ([f[k] for f in found] for k in range(3))
            pdf["breaks"] = [[dict(zip(("i", "j", "left", "right", "sign"), b)) for b in f[3]] for f in found]
            pdf["asked"] = [asked(f[3]) for f in found]
            yield pdf.drop(columns="title")

    kind = docs.schema["_key"].dataType.simpleString()
    rows = written(rows.mapInPandas(read, f"_key {kind}, text string, site array<int>, pages array<int>, heads array<int>, numbered array<int>, breaks {BREAK}, asked array<string>"), "layout")
    questions = rows.select("_key", F.explode("asked").alias("w"))
    rights = written(right_words(counts, questions.select("w").distinct()), "rights").select("w", "right", F.col("n").alias("m"))
    none = F.lit(None)
    known = questions.join(counts, "w").select("_key", "w", "n", none.cast("string").alias("right"), none.cast("bigint").alias("m"))
    own = docs.select("_key", F.explode(F.array_distinct("words")).alias("w")).unionByName(questions).join(rights, "w").select("_key", "w", none.cast("bigint").alias("n"), "right", "m")
    answers = known.unionByName(own).groupBy("_key").agg(F.collect_set(F.struct("w", "n", "right", "m")).alias("answers"))

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cases, texts = [], []
            for t, s, p, h, d, b, a in zip(*(pdf[c] for c in ("text", "site", "pages", "heads", "numbered", "breaks", "answers"))):
                if t is None or not t.strip():
                    cases.append([])
                    texts.append(t)
                    continue
                a = [] if a is None else a
                n = {x["w"]: int(x["n"]) for x in a if x["right"] is None}
                r = {x["w"]: (x["right"], int(x["m"])) for x in a if x["right"] is not None}
                c, fixed = examine(t, set() if s is None else set(s), (p, h, d, [tuple(x[k] for k in ("i", "j", "left", "right", "sign")) for x in b]), n, r)
                cases.append([{"riga": int(i) + 1, "tipo": k} for i, k in sorted(set(c))])
                texts.append(fixed)
            yield pd.DataFrame({key: pdf["_key"], "cases": cases, "text": pd.Series(texts, dtype=object)})

    return rows.join(answers, "_key", "left").mapInPandas(repair, f"`{key}` {kind}, cases array<struct<riga: bigint, tipo: string>>, text string")
