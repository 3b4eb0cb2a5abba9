"""Personal data in free text: e-mail addresses, phone and identity numbers, street addresses and names of persons.

A linear-chain conditional random field labels the words of each sentence, and its labels are the items: where one begins
and ends, and of which kind it is. A word enters by its features: itself if the labelled table has it outside items, its
shape (case, digits, length, ending), whether it stands in a list (given names, trades, kinds of street, words of bodies),
and whether it lies in a match of one of the patterns of e-mail addresses, numbers and addresses. The lists and patterns
are features like the others: nothing is an item because of them, nor fails to be one. About half of the given names that
the field is trained on stand in no list, so a name is found by its shape and the words around it.

The weights of a feature are learned for each place from three words before to three after. Words with the same features
are one type, whose scores are summed up once; the field is trained by gradient steps on the small labelled table and
decoded by Viterbi in numpy batches, once for each different sequence of types in a task. Of the names found only those
with a legal form of firms beside them, of a single word, or without capitals in a text that has some are put aside; so a
sentence without any match and without two capitals side by side need not be decoded.

Defined results: null and empty texts have no items and stay as they are; the same value twice in a text is one row but
both places are replaced; sentences of any length are decoded in overlapping windows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivano.llm.labelled import ITEMS, KNOWN, SENTENCES, table
from scrivano.llm.name_variants import FORMS, GIVEN, SHORT, SMALL, TRADES, distance, plain

LABELS = ["O"] + [f"{p}-{k}" for k in ITEMS for p in "BI"]
AROUND = range(-3, 4)
TOKEN = re.compile(r"\s*(?:[^\W_]+|[^\w\s]|_)")
END = re.compile(r"[.;](?=\s+[A-ZÀ-Ý])|\n\s*(?=(?:OGGETTO|DETERMINA|DELIBERA|ORDINA|DECRETA|RENDE NOTO|AVVISA)\b)")
# Two words with capitals side by side, or with a small word between: what a name has at least, in a text with capitals.
CAPITALS = re.compile(r"[A-ZÀ-Ý][\w'’]*[.,\s-]+(?:(?:d[aei]|de[il]|del+[aoe']|l[aeo]|v[ao]n)\s+)?[A-ZÀ-Ý]")
NEXT = re.compile(r"\s+[A-ZÀ-Ý][a-zà-ÿ]")
KINDS = set("via viale piazza largo corso vicolo contrada piazzale strada vle zza so".split())
LEANING = 0.8  # a name missed is worse than one too many
DROPPED = 0.4  # share of the words of the labelled table that are trained without themselves and their endings
WINDOW, OVERLAP = 400, 80  # an item of more than 40 words may be cut where two windows meet
# Words of public and private bodies.
BODIES = set("comune provincia regione unione consorzio azienda agenzia ente istituto banca cassa poste croce associazione fondazione cooperativa impresa ditta societa studio gruppo pro loco asl inps ministero prefettura scuola liceo universita parrocchia comitato autorita camera tribunale protezione civile".split())
CODES = [(re.compile(p), k) for p, k in (
    (r"[A-Z]{6}\d\d[A-Z]\d\d[A-Z]\d{3}[A-Z]", "<cf>"), (r"[a-z]{6}\d\d[a-z]\d\d[a-z]\d{3}[a-z]", "<cf>"), (r"[A-Z]{2}\d{5}[A-Z]{2}", "<ci>"), (r"[A-Z]{2}\d{7}", "<pp>"),
    (r"\d\d[A-Z]\d\d", "<cf3>"), (r"[A-Z]\d{3}[A-Z]", "<cf4>"))]
# Words of offices, and words that names of places are made with.
OFFICES = set("area settore servizio servizi ufficio uffici polizia direzione segreteria sportello centro sezione reparto gestione lavori opere urbanistica tributi anagrafe personale patrimonio ragioneria".split())
SPOTS = set("borgo colle casale rupe ponte torre castel castello monte san santa sant rocca villa pian piano poggio pieve vico campo valle val fonte porto costa bosco serra isola lago alto alta vecchio vecchia nuovo nuova basso bassa".split())
# The patterns below are looked for where their first sign, or the first figure of a number, stands: a regular expression
# that begins with a set of characters is searched many times faster than one that begins with a look at what is before.
SIGN = re.compile(r"[@\[(](?:(?<=@)|(?:chiocciola|at)[\])])", re.I)
PHONE_AT = re.compile(r"[+(03](?<![\w/.].)")
IDENTITY_AT = re.compile(r"\d(?:(?<=[A-Za-z]\d)|(?<=[A-Za-z]\s\d))\d")
ADDRESS_AT = re.compile(r"[vplcsVPLCS\u017f](?<!\w\w)(?i:(?<=v)(?:ia|iale|\.le|icolo)|(?<=p)(?:iazza|\.zza|iazzale)|(?<=l)argo|(?<=c)(?:orso|\.so|ontrada|\.da)|(?<=s)trada)\s")
HOST, LOCAL = re.compile(r"[\w-]+(?:\.[\w-]+)+"), re.compile(r"[\w.+-]+\Z")
PHONE = re.compile(r"(?<![\w/.])(?:(?:\+|00)\d{2}[\s.-]?)?(?:\(0\d{1,4}\)|0\d{1,4}|3\d{2})[\s./-]{0,2}\d(?:[\s./-]?\d){4,8}(?!\d)")
IDENTITY = re.compile(r"\b[A-Za-z](?=[A-Za-z](?:\d|[A-Za-z](?:\s|[A-Za-z]{3}\d)))(?:[A-Za-z]{5}\d\d[A-Za-z]\d\d[A-Za-z]\d{3}[A-Za-z]|[A-Za-z]{2}\s[A-Za-z]{3}\s\d\d[A-Za-z]\d\d\s[A-Za-z]\d{3}[A-Za-z]|[A-Za-z]\d{5}[A-Za-z]{2}|[A-Za-z]\d{7})(?!\w)")
ADDRESS = re.compile(
    r"(?<!\w)(?:via|viale|v\.le|piazza|p\.zza|piazzale|largo|corso|c\.so|vicolo|contrada|c\.da|strada)\s+(?P<street>(?:[^\W\d_]++['’]?[\s.]*+){1,6}?)"
    r",?\s*(?:n\.?\s*|n°\s*|civico\s*)?\d{1,4}(?:\s?/\s?[A-Za-z](?!\w)|\s(?:bis|ter|quater)(?!\w))?(?:,?\s(?:int|scala|piano)\.?\s\d+)?(?:\s?[,-]\s?\d{5}\s(?P<place>[^\W\d_]+(?:['’][^\W\d_]+)?))?", re.I)  # fmt: skip


BY_ENDS: dict[tuple[str, str], list[str]] = {}
for _name in sorted(GIVEN):
    BY_ENDS.setdefault((_name[0], _name[-1]), []).append(_name)


@lru_cache(maxsize=200_000)
def given(word: str) -> bool:
    """Whether a word is a given name, allowing for a slip in longer ones."""
    w = plain(word)
    if w in GIVEN or w in SHORT:
        return True
    return len(w) > 4 and any(abs(len(g) - len(w)) < 2 and distance(g, w, 1) < 2 for g in BY_ENDS.get((w[0], w[-1]), ()))


LISTS = (("kind", KINDS), ("trade", TRADES), ("body", BODIES), ("office", OFFICES), ("spot", SPOTS))


def shape(word: str) -> str:
    for rx, k in CODES:
        if rx.fullmatch(word):
            return k
    if word.isdigit():
        return f"<d{min(len(word), 12)}{'0' if word[0] == '0' and len(word) > 3 else '3' if word[0] == '3' and len(word) > 2 else ''}>"
    case = "A" if word.isupper() else "Aa" if word[0].isupper() else "a"
    if any(c.isdigit() for c in word):
        return f"<mixed{case}{min(len(word), 9)}>"
    return f"<letter{case}>" if len(word) == 1 else f"<{case}>"


def features(word: str, known: set[str]) -> list[str]:
    """Features of a word, whatever stands around it."""
    if not word.isalnum():
        return [word]
    low = word.lower()
    out = [shape(word)]
    if len(low) > 1 and low in known:
        out.append("=" + low)
    if word.isalpha() and len(word) > 1:
        case, n = out[0], len(word)
        out += [f"{case}{2 if n < 4 else 4 if n < 6 else 6 if n < 9 else 9}", f"-{low[-1]}"] + ([f"-{low[-3:]}"] if n > 4 else [])
        bare = plain(low)
        lists = [k for k, own in LISTS if bare in own] or ["given"] * given(word) or ["none"]
        out += [f"{k}{case}" for k in lists]
    return out


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0  # end of the sign before, with the blank after it
    for m in SIGN.finditer(text):
        start, end = m.span()
        sign = start = start - (start > last and text[start - 1].isspace())
        last = end = end + text[end : end + 1].isspace()
        while start and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
            start -= 1
        host = HOST.match(text, end)
        if host and start < sign:
            yield start, host.end()


def matches(rx: re.Pattern, text: str, starts: Iterator[int] | list[int]) -> Iterator[re.Match]:
    """What `rx.finditer` gives, if all its matches begin at `starts`."""
    last = 0
    for a in starts:
        if a >= last and (m := rx.match(text, a)):
            last = m.end()
            yield m


def identities(text: str) -> Iterator[re.Match]:
    """Their first figure comes after two, six or, with blanks, eight characters."""
    return matches(IDENTITY, text, sorted({m.start() - n for m in IDENTITY_AT.finditer(text) for n in (2, 6, 8) if m.start() >= n}))


def phones(text: str) -> Iterator[re.Match]:
    return matches(PHONE, text, (m.start() for m in PHONE_AT.finditer(text)))


def addresses(text: str) -> Iterator[re.Match]:
    return matches(ADDRESS, text, (m.start() for m in ADDRESS_AT.finditer(text)))


def with_place(text: str, m: re.Match, places: list[str]) -> int:
    """End of an address, its place in full if that is one of `places`."""
    if m["place"]:
        rest = text[m.start("place") :]
        for p in places:
            words = p.split()
            if hit := re.match(r"\s+".join(map(re.escape, words)) + r"(?!\w)", rest[: 4 * len(p) + 40], re.I):
                return m.start("place") + hit.end()
    return m.end()


@lru_cache(maxsize=4)
def any_of(places: tuple[str, ...]) -> re.Pattern:
    """Matches the longest of some names, with any white space inside."""
    every, own = "".join(map(chr, range(0x110000))), {}
    for p in sorted((p.strip() for p in places if p.strip()), key=lambda p: -len(p)):
        same = "".join(re.findall(re.escape(p[0]), every, re.I))  # its first letter in either case
        own.setdefault(same, []).append(r"\s+".join(map(re.escape, [p.split()[0][1:], *p.split()[1:]])))
    if not own:
        return re.compile(r"(?!)")
    # begins with the set of their first letters, see SIGN
    rest = "|".join(f"(?<=[{re.escape(same)}])(?:{'|'.join(names)})" for same, names in own.items())
    return re.compile(rf"[{re.escape(''.join(own))}](?<!\w\w)(?i:{rest})(?!\w)")


def street_words(street: str) -> bool:
    """Whether the words between a kind of street and a number can be its name: a sentence that goes on has small words after capitals."""
    if re.search(r"[^\W\d_]{4}\.\s", street):  # the end of a sentence
        return False
    words = [w for w in re.findall(r"[^\W\d_]+", street) if w.lower() not in ("n", "nr", "civico")]
    if not words or words[-1].lower() in SMALL:
        return False
    return len({w[0].isupper() for w in words if w.lower() not in SMALL}) < 2


def marks(text: str, places: list[str]) -> list[tuple[int, int, str]]:
    """Matches of the patterns, in order; of those that overlap the first of e-mail, identity, address, phone, known place."""
    out: list[tuple[int, int, str]] = []
    for kind, found_ in (
        ("mail", emails(text)), ("id", (m.span() for m in identities(text))),
        ("street", ((m.start(), with_place(text, m, places)) for m in addresses(text) if street_words(m["street"]))), ("phone", (m.span() for m in phones(text))),
        ("place", (m.span() for m in any_of(tuple(places)).finditer(text)) if places else ()),
    ):
        new = [(a, b, kind) for a, b in found_]
        if new:
            before = list(out)
            out += [x for x in new if all(x[1] <= y[0] or y[1] <= x[0] for y in before)]
    return sorted(out)


class Types:
    """Numbers of features and of types, which are words with the same features."""

    def __init__(self) -> None:
        # words of the sentences themselves, not of the values put into them
        own = re.findall(r"[^\W\d_]{2,}", re.sub(r"\{\w+\}", " ", SENTENCES).lower())
        parts = "bis int scala piano example chiocciola at info dei della delle degli del dell".split()
        self.known = {w for w in [*own, *parts] if not given(w)}
        self.feature: dict[str, int] = {}
        self.types: dict[tuple[int, ...], int] = {}
        self.memo: dict[tuple[str, str, str, bool], int] = {}
        self.steps: dict[tuple[str, str], tuple[int, str]] = {}
        self.new = True
        self.of("", "edge")
        bare = random.Random(1)  # words and endings are left out at times, so that the field does not hang on them, and of marked words all but the marks
        self.sentences = []
        for pieces in table():
            text = "".join(p for p, _ in pieces)
            label = np.zeros(len(text) + 1, int)
            at = 0
            for p, k in pieces:
                if k:
                    label[at : at + len(p)] = 2 * ITEMS.index(k) + 2
                    label[at] = 2 * ITEMS.index(k) + 1
                at += len(p)
            spans = spans_of(text, 0, len(text))
            self.sentences.append((self.sequence(text, spans, marks(text, KNOWN), bare), [int(label[a]) for a, _ in spans]))
        self.new = False

    def of(self, token: str, mark: str = "", before: str = "", bare: bool = False) -> int:
        """Type of a token with the white space before it, the mark it stands in and the case of the word before. `bare`
        leaves the word itself and its ending out, and of a marked word all but the mark and the number of its digits."""
        k = self.memo.get((token, mark, before, bare))
        if k is None:
            word = token.lstrip()
            if not word or bare and mark:
                names = [mark, *([shape(word)] if word.isdigit() else [])]
            else:
                own = features(word, self.known)
                own += ["lower"] * (before[:1] == "*")  # a word of a text without capitals
                names = [*(f for f in own if not bare or f[0] not in "=-" or f == word), mark or "unmarked", f"{before}>{self.case(token)}"] + ["~"] * (word != token)
            if self.new:
                for f in names:
                    self.feature.setdefault(f, len(self.feature))
            combo = tuple(sorted(self.feature[f] for f in names if f in self.feature))
            k = self.types.setdefault(combo, len(self.types))
            if len(self.memo) > 600_000:
                self.memo.clear()
            self.memo[token, mark, before, bare] = k
        return k

    def case(self, token: str) -> str:
        word = token.lstrip()
        if not word[0].isalpha():
            return "0" if word[0].isdigit() else word
        return "A." if len(word) == 1 and word.isupper() else "A" if word.isupper() else "Aa" if word[0].isupper() else "a"

    def plain_sequence(self, tokens: list[str], low: str = "") -> list[int]:
        """Types of tokens outside all matches; `low` is * in a text without capitals."""
        out, before, steps = [], low, self.steps
        for token in tokens:
            step = steps.get((token, before))
            if step is None:
                if len(steps) > 600_000:
                    steps.clear()
                step = steps[token, before] = (self.of(token, "", before), low + self.case(token))
            out.append(step[0])
            before = step[1]
        return out

    def marked_sequence(self, text: str, at: int, tokens: list[str], found_: list[tuple[int, int, str]], m: int, low: str = "") -> list[int]:
        """Types of the tokens of a sentence from `at` on, which has the match `m` and perhaps others after it; as `sequence`,
        but tokens outside all matches are looked up as in `plain_sequence`."""
        out, before, steps, b = [], low, self.steps, at
        begins, ends, kind = found_[m]
        for token in tokens:
            a, b = b, b + len(token)
            if b > begins:
                a = b - len(token.lstrip())
                while ends <= a:
                    m += 1
                    begins, ends, kind = found_[m] if m < len(found_) else (len(text) + 1, len(text) + 2, "")
            if not out and a == at and at and text[at - 1].isspace():
                token = " " + token
            if a >= begins:
                mark = kind + ("S" if begins == a and ends <= b else "B" if begins == a else "E" if ends <= b else "I")
                out.append(self.of(" " + text[a:b] if token[0].isspace() else token, mark, before))
                before = low + self.case(token)
                continue
            step = steps.get((token, before))
            if step is None:
                if len(steps) > 600_000:
                    steps.clear()
                step = steps[token, before] = (self.of(token, "", before), low + self.case(token))
            out.append(step[0])
            before = step[1]
        return out

    def sequence(self, text: str, spans: list[tuple[int, int]], found_: list[tuple[int, int, str]], bare: random.Random | None = None) -> list[int]:
        """Types of the tokens at `spans`, with the marks of the matches they lie in: at the beginning, inside, at the end."""
        low = "*" if text.islower() else ""
        out, last, m, before = [], 0 if not spans else spans[0][0], 0, low
        for a, b in spans:
            while m < len(found_) and found_[m][1] <= a:
                m += 1
            mark = ""
            if m < len(found_) and found_[m][0] <= a:
                begins, ends = found_[m][0] == a, found_[m][1] <= b
                mark = found_[m][2] + ("S" if begins and ends else "B" if begins else "E" if ends else "I")
            token = (" " if a > last or not out and a and text[a - 1].isspace() else "") + text[a:b]
            out.append(self.of(token, mark, before, bare is not None and bare.random() < DROPPED))
            last, before = b, low + self.case(token)
        return out


def sentences_of(text: str) -> Iterator[tuple[int, int]]:
    """Sentences end at a stop or semicolon after five letters or after a figure, and before the headings of acts."""
    at = 0
    for m in END.finditer(text):
        end = m.end()
        if text[m.start()] != "\n":
            before = text[max(0, end - 6) : end - 1]
            if not (len(before) == 5 and before.isalpha()):
                if not (before[-1:].isdigit() and NEXT.match(text, end)):
                    continue
        yield at, end
        at = end
    yield at, len(text)


def spans_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [(m.end() - len(m[0].lstrip()), m.end()) for m in TOKEN.finditer(text, start, end)]


class Field:
    """The conditional random field: weights of the features around a word, and of neighbouring labels. `w` holds the sums
    of the weights of each type."""

    def __init__(self, types: int):
        self.k = len(LABELS)
        self.w = np.zeros((len(AROUND), types, self.k))
        self.weights = np.zeros((len(AROUND), 0, self.k))
        self.t = np.zeros((self.k + 1, self.k))  # last row: first word
        for j, name in enumerate(LABELS):
            if name[0] == "I":
                for i, before in enumerate([*LABELS, "start"]):
                    if before[2:] != name[2:] or before == "start":
                        self.t[i, j] = -1e4
        self.fixed = self.t < -1e3

    def scores(self, x: np.ndarray) -> np.ndarray:
        """x: types padded by 3 edges at both ends (n, length + 6); scores (n, length, labels)."""
        length = x.shape[1] - 6
        return sum(self.w[a][x[:, a : a + length]] for a in range(len(AROUND)))

    def grow(self, types: Types) -> None:
        """Adds the sums of types that were not there before."""
        have = self.w.shape[1]
        if have < len(types.types):
            new = [self.weights[:, list(combo)].sum(axis=1) for combo in list(types.types)[have:]]
            self.w = np.concatenate([self.w, np.stack(new, axis=1).astype(self.w.dtype)], axis=1)

    def train(self, types: Types, steps: int = 120, rate: float = 0.2, decay: float = 0.2) -> Field:
        sentences = types.sentences
        member = np.zeros((len(types.types), len(types.feature)))  # features of each type
        for n, combo in enumerate(types.types):
            member[n, list(combo)] = 1
        self.weights = np.zeros((len(AROUND), len(types.feature), self.k))
        groups: dict[int, list[tuple[list[int], list[int]]]] = {}
        for s in sentences:
            groups.setdefault(-(-len(s[0]) // 8) * 8, []).append(s)
        batches = []
        for length, own in sorted(groups.items()):
            x, y, m = np.zeros((len(own), length + 6), int), np.zeros((len(own), length), int), np.zeros((len(own), length), bool)
            for i, (a, b) in enumerate(own):
                x[i, 3 : 3 + len(a)], y[i, : len(b)], m[i, : len(b)] = a, b, True
            batches.append((x, y, m))
        gw, gt = np.zeros_like(self.weights), np.zeros_like(self.t)
        for _ in range(steps):
            self.w = member @ self.weights
            dw, dt = np.zeros_like(self.w), np.zeros_like(self.t)
            for x, y, m in batches:
                self._gradient(x, y, m, dw, dt)
            df = member.T @ dw - decay * self.weights
            dt -= decay * np.where(self.fixed, 0, self.t)
            dt[self.fixed] = 0
            gw += df * df
            gt += dt * dt
            self.weights += rate * df / np.sqrt(gw + 1e-6)
            self.t += rate * dt / np.sqrt(gt + 1e-6)
        self.w = (member @ self.weights).astype(np.float32)
        self.t[:, LABELS.index("B-nome")] += LEANING
        return self

    def _gradient(self, x: np.ndarray, y: np.ndarray, m: np.ndarray, dw: np.ndarray, dt: np.ndarray) -> None:
        s = self.scores(x)
        n, length, k = s.shape
        fwd, back = np.empty_like(s), np.zeros_like(s)
        e = np.exp(np.maximum(self.t, -60))
        z = np.zeros((n, length))
        p = np.exp(s - s.max(axis=2, keepdims=True))
        for i in range(length):
            a = p[:, i] * (e[k] if i == 0 else fwd[:, i - 1] @ e[:k])
            z[:, i] = a.sum(axis=1)
            fwd[:, i] = a / z[:, i : i + 1]
        last = m.sum(axis=1) - 1
        back[:, length - 1] = 1
        for i in range(length - 2, -1, -1):
            b = (p[:, i + 1] * back[:, i + 1]) @ e[:k].T / z[:, i + 1 : i + 2]
            back[:, i] = np.where((i >= last)[:, None], 1.0, b)
        gamma = fwd * back
        gamma /= gamma.sum(axis=2, keepdims=True)
        d = -gamma
        d[np.arange(n)[:, None], np.arange(length)[None, :], y] += 1
        d *= m[:, :, None]
        for a in range(len(AROUND)):
            at = x[:, a : a + length].ravel()
            dw[a] += np.stack([np.bincount(at, d[:, :, j].ravel(), dw.shape[1]) for j in range(k)], axis=1)
        dt[k] += d[:, 0].sum(axis=0)
        for i in range(1, length):
            on = m[:, i]
            if on.any():
                pair = fwd[on, i - 1][:, :, None] * e[None, :k] * (p[on, i] * back[on, i])[:, None, :]
                pair /= pair.sum(axis=(1, 2), keepdims=True)
                dt[:k] -= pair.sum(axis=0)
                np.add.at(dt, (y[on, i - 1], y[on, i]), 1)

    def decode(self, sequences: list[tuple[int, ...]]) -> list[list[int]]:
        """Best labels of each sequence, by Viterbi over batches of like length; an empty list where all are O."""
        out: list[list[int]] = [[] for _ in sequences]
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        step, first = self.t[: self.k].astype(self.w.dtype), self.t[self.k].astype(self.w.dtype)
        for start in range(0, len(order), 512):
            part = order[start : start + 512]
            n = np.array([len(sequences[i]) for i in part])
            length = int(n[-1])
            x = np.zeros((len(part), length + 6), int)
            for r, i in enumerate(part):
                x[r, 3 : 3 + len(sequences[i])] = sequences[i]
            s = self.scores(x)
            best, came, last = s[:, 0] + first, np.zeros(s.shape, np.int8), np.zeros(len(part), int)
            for j in range(length):
                if j:
                    c = best[:, :, None] + step
                    came[:, j] = c.argmax(axis=1)
                    best = c.max(axis=1) + s[:, j]
                done = np.flatnonzero(n == j + 1)
                last[done] = best[done].argmax(axis=1)
            labels, now, rows = np.zeros((len(part), length), np.int8), np.zeros(len(part), int), np.arange(len(part))
            for j in range(length - 1, -1, -1):
                now = np.where(n == j + 1, last, now)
                labels[:, j] = now
                now = came[rows, j, now]
            labels[np.arange(length) >= n[:, None]] = 0
            for r in np.flatnonzero(labels.any(axis=1)):
                out[part[r]] = labels[r, : n[r]].tolist()
        return out


@lru_cache(maxsize=1)
def trained() -> tuple[Types, Field]:
    """The field trained on the whole labelled table, once in a process."""
    types = Types()
    field = Field(len(types.types)).train(types)
    types.sentences = []
    return types, field


def is_name(text: str, start: int, end: int, low: bool) -> bool:
    """False for what the field takes for a name of a person and surely is none: a single word, words without capitals in a
    text that has some, or the name of a firm."""
    words = re.findall(r"[^\W\d_]+", text[start:end])
    if len(words) < 2 or not any(len(w) > 1 for w in words) or not low and any(w.islower() and w not in SMALL for w in words):
        return False
    return not any(m.start() < end + 3 for rx, _ in FORMS for m in rx.finditer(text, start, end + 25))


def windows(length: int) -> Iterator[tuple[int, int, int, int]]:
    """Windows over a sentence: begin, end, and the part whose labels count."""
    step, at = WINDOW - OVERLAP, 0
    while True:
        last = at + WINDOW >= length
        yield at, min(length, at + WINDOW), at + (OVERLAP // 2 if at else 0), length if last else at + WINDOW - OVERLAP // 2
        if last:
            return
        at += step


def found(texts: list[str | None], types: Types, field: Field, cache: dict[tuple[int, ...], list[int]], places: list[str]) -> list[list[tuple[int, int, str]]]:
    """Places (start, end, kind) of the items of each text."""
    sentences: list[tuple[int, int, list[str], list[tuple[tuple[int, ...], int, int]]]] = []
    new: dict[tuple[int, ...], None] = {}
    if len(cache) > 300_000:
        cache.clear()
    for n, t in enumerate(texts):
        if not t:
            continue
        hits, h, low = marks(t, places), 0, t.islower()
        for at, end in sentences_of(t):
            while h < len(hits) and hits[h][1] <= at:
                h += 1
            marked = h < len(hits) and hits[h][0] < end
            if not marked and not low and not CAPITALS.search(t, at, end):
                continue  # neither a match nor what a name has at least
            tokens = TOKEN.findall(t, at, end)
            seq = types.marked_sequence(t, at, tokens, hits, h, "*" if low else "") if marked else types.plain_sequence(tokens, "*" if low else "")
            if len(seq) <= WINDOW:
                parts = [(tuple(seq), 0, len(seq))]
            else:
                parts = [(tuple(seq[a:b]), left - a, right - a) for a, b, left, right in windows(len(seq))]
            for part, _, _ in parts:
                if part not in cache:
                    new[part] = None
            sentences.append((n, at, tokens, parts))
    field.grow(types)
    for seq, labels in zip([s for s in new if s], field.decode([s for s in new if s])):
        cache[seq] = labels
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for n, at, tokens, parts in sentences:
        if len(parts) == 1:
            labels = cache.get(parts[0][0])
        else:
            labels = [k for p, a, b in parts for k in ((cache.get(p) or [0] * len(p))[a:b])]
        if not labels:
            continue
        ends = list(accumulate(map(len, tokens), initial=at))  # tokens follow each other without a gap
        i = 0
        while i < len(labels):
            j = i + 1
            if labels[i]:
                kind = (labels[i] - 1) // 2
                while j < len(labels) and labels[j] == 2 * kind + 2:
                    j += 1
                start, stop = ends[i + 1] - len(tokens[i].lstrip()), ends[j]
                if ITEMS[kind] != "nome" or is_name(texts[n], start, stop, texts[n].islower()):
                    out[n].append((start, stop, ITEMS[kind]))
            i = j
    return out


def personal(rows: DataFrame, key: str, text: str, places: list[str] | None = None) -> DataFrame:
    """(`key`, items array of (tipo, valore), text with typed placeholders). The field is trained once and sent to the tasks."""
    shared = rows.sparkSession.sparkContext.broadcast((trained(), places or []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (types, field), known = shared.value
        cache: dict[tuple[int, ...], list[int]] = {}
        for pdf in batches:
            texts = [t if isinstance(t, str) else None for t in pdf["_text"]]
            items, safe = [], []
            different = list(dict.fromkeys(texts))  # equal texts are read once
            hits = dict(zip(different, found(different, types, field, cache, known)))
            for t, places_ in ((t, hits[t]) for t in texts):
                own, out, at = {}, [], 0
                for a, b, k in places_:
                    own[k, " ".join(t[a:b].split())] = None
                    out += [t[at:a], f"[{k.upper()}]"]
                    at = b
                items.append([{"tipo": k, "valore": v} for k, v in own])
                safe.append("".join([*out, t[at:]]) if t is not None else None)
            yield pd.DataFrame({key: pdf[key], "items": items, "text": pd.Series(safe, dtype=object)})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key), F.col(text).alias("_text")).mapInPandas(run, f"`{key}` {kind}, items array<struct<tipo: string, valore: string>>, text string")
