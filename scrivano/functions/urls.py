"""Web addresses of notices and their attachments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivano.functions.text import col, slug

# File endings and words of links that lead to a document, and endings by media type.
ENDINGS = (".pdf", ".p7m", ".doc", ".docx", ".zip")
LINK_WORDS = ("allegato", "documento", "pdf", "download", "vai")
MEDIA = {"application/pdf": ".pdf", "application/pkcs7-mime": ".p7m", "application/zip": ".zip", "text/html": ".html"}


def query_value(c: str | Column, key: str) -> Column:
    return F.nullif(F.regexp_extract(col(c), rf"[?&]{key}=([^&#]*)", 1), F.lit(""))


def document_name(c: str | Column) -> Column:
    """Last part of the document's name in the query, else of the path."""
    u = F.coalesce(col(c), F.lit(""))
    path = F.regexp_extract(u, r"^(?:[a-z]+://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_extract(F.coalesce(*(query_value(u, k) for k in ("f", "file", "filename", "name")), path), r"([^/]*)$", 1)


def is_attachment(c: str | Column, label: str | Column | None = None) -> Column:
    name = F.lower(document_name(c))
    out = F.lower(F.coalesce(col(c), F.lit(""))).contains("getdoc.php")
    for e in ENDINGS:
        out = out | name.endswith(e)
    if label is not None:
        text = F.lower(F.coalesce(col(label), F.lit("")))
        for w in LINK_WORDS:
            out = out | text.contains(w)
    return out


def next_page(c: str | Column, page: str = "pagina") -> Column:
    """Address of the following page of a list; page 1 where none is given."""
    n = F.coalesce(query_value(c, page).try_cast("bigint"), F.lit(1)) + 1
    mark = F.when(F.contains(col(c), F.lit("?")), "&").otherwise("?")
    return F.when(query_value(c, page).isNotNull(), F.regexp_replace(col(c), F.lit(rf"([?&]{page}=)[^&#]*"), F.concat(F.lit("$1"), n.cast("string")))).otherwise(F.concat(col(c), mark, F.lit(f"{page}="), n.cast("string")))


def page_start(page: str | Column, step: int = 15) -> Column:
    return 1 + (col(page) - 1) * step


def page_step(page: str | Column, start: str | Column, default: int = 15) -> Column:
    """Rows of a list page, estimated from a later page and where it starts; `default` where that gives nothing from 5 to 50."""
    page, start = col(page), col(start)
    guess = F.bround((start - 1) / F.when(page > 1, page - 1)).cast("int")
    return F.when((start > 1) & guess.between(5, 50), guess).otherwise(default)


def next_start(page: str | Column, start: str | Column, default: int = 15) -> Column:
    """Where the page after `page` starts."""
    return 1 + col(page) * page_step(page, start, default)


def extension(url: str | Column, media: Column | None = None) -> Column:
    """Ending of a document: by media type, else that of the address, else `.bin`."""
    known = F.lit(None).cast("string")
    if media is not None:
        for k, v in MEDIA.items():
            known = F.when(media.startswith(k), v).otherwise(known)
    return F.coalesce(known, F.nullif(F.lower(F.regexp_extract(document_name(url), r"(\.[A-Za-z0-9]{1,5})$", 1)), F.lit("")), F.lit(".bin"))


def file_stem(parts: list[str | Column], place: str | Column) -> Column:
    """File name of a download: slug of its parts and its place."""
    return F.concat(slug(F.concat_ws("_", *(col(p) for p in parts)), 100), F.lit("_"), col(place).cast("string"))


def token_of(url: str | Column, html: str | Column) -> Column:
    """Session token: of the address, else of the page."""
    return F.coalesce(query_value(url, "csrf"), F.nullif(F.regexp_extract(F.coalesce(col(html), F.lit("")), r"csrf[\"']?\s*(?:value=|[:=])\s*[\"']([^\"']+)", 1), F.lit("")))
