"""List and detail pages of notice boards, read with the HTML parser of the standard library inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEXT = re.compile(r"(?i)success|avanti|prossim|next|^\s*(?:>|›|»|>>)\s*$")
NUMBER, DATE = re.compile(r"(?i)\bn(?:\.|umero|°)\s*(\d{1,6})"), re.compile(r"\b(\d{2}/\d{2}/\d{4})\b")
KIND = re.compile(r"(?i)\b(delibera|determinazione|ordinanza|avviso|bando)\b")  # fixed values: kinds that list pages name
SUBJECT, OFFICE = re.compile(r"(?i)oggetto\s*[:|]+\s*([^|]+)"), re.compile(r"(?i)(?:ufficio|settore|area)\s*[:|]+\s*([^|]+)")


class _Reader(HTMLParser):
    """Rows (`tr`, else `li` and `div`) with their text and links, and the title of a page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.rows, self.links, self.title, self.text = {"tr": [], "li": []}, [], "", []
        self._open: list[tuple[str, dict]] = []
        self._link: dict | None = None
        self._in: list[str] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        self._in.append(tag)
        if tag in ("tr", "li", "div"):
            self._open.append((tag, {"text": [], "links": []}))
        if tag == "a" and a.get("href"):
            self._link = {"href": a["href"], "text": "", "rel": a.get("rel") or ""}

    def handle_data(self, data: str) -> None:
        if "title" in self._in[-1:]:
            self.title += data
        elif not {"script", "style"} & set(self._in[-1:]) and data.strip():
            self.text.append(data.strip())
            for _, row in self._open:
                row["text"].append(data.strip())
            if self._link is not None:
                self._link["text"] += data.strip()

    def handle_endtag(self, tag: str) -> None:
        while self._in and self._in[-1] != tag and tag in self._in:
            self._in.pop()
        if self._in and self._in[-1] == tag:
            self._in.pop()
        if tag == "a" and self._link is not None:
            self.links.append(self._link)
            for _, row in self._open:
                row["links"].append(self._link)
            self._link = None
        if tag in ("tr", "li", "div") and self._open and self._open[-1][0] == tag:
            kind, row = self._open.pop()
            if row["links"]:
                self.rows["tr" if kind == "tr" else "li"].append(row)


def list_rows(url: str, html: str) -> list[tuple[str, str, str | None, str | None, str | None, str | None]]:
    """(address, title, number, date, kind of act, kind of next link) of each row with a link; the table is preferred to list items."""
    r = _Reader(html or "")
    out = []
    for row in r.rows["tr"] or r.rows["li"]:
        text, link = " ".join(row["text"]), row["links"][0]
        n, d, k = NUMBER.search(text), DATE.search(text), KIND.search(text)
        out.append((urljoin(url or "", link["href"]), link["text"] or "Documento", n[1] if n else None, d[1] if d else None, k[1].capitalize() if k else None, "next" if NEXT.search(link["text"]) or link["rel"] == "next" else None))
    return out


def next_link(url: str, html: str) -> str | None:
    links = _Reader(html or "").links
    hit = next((x for x in links if x["rel"] == "next"), None) or next((x for x in links if NEXT.search(x["text"])), None)
    return urljoin(url or "", hit["href"]) if hit else None


def detail(url: str, html: str) -> tuple[str | None, str | None, list[str]]:
    """Subject, office and attachments of a detail page."""
    r = _Reader(html or "")
    text = "|".join(r.text)
    s, o = SUBJECT.search(text), OFFICE.search(text)
    good = re.compile(r"(?i)\.(?:pdf|p7m|docx?|zip)(?:$|[?#])|getdoc\.php")
    words = re.compile(r"(?i)allegato|documento|pdf|download|vai")
    files = dict.fromkeys(urljoin(url or "", x["href"]) for x in r.links if good.search(x["href"]) or words.search(x["text"]))
    return (s[1].strip() if s else None, o[1].strip() if o else None, list(files))


def listed_notices(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page_url, dettaglio_url, titolo, numero, data_pubblicazione, tipologia) of all list pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(u, *r[:5]) for u, h in zip(pdf[url], pdf[html]) for r in list_rows(u, h) if r[5] is None]
            yield pd.DataFrame(rows, columns=["page_url", "dettaglio_url", "titolo", "numero", "data_pubblicazione", "tipologia"])

    return pages.select(url, html).filter(F.col(html).isNotNull()).mapInPandas(run, "page_url string, dettaglio_url string, titolo string, numero string, data_pubblicazione string, tipologia string")
