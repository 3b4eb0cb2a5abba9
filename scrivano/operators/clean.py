"""Formal passages taken out of acts by patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivano.functions.text import col, words

# Passages that most acts carry, {place} standing for the name of the town. They are deleted in this order,
# in any case, across line breaks.
PASSAGES = (
    r"COPIA Piazza Municipio[^\n]*?http://www\.comune\.{place}\.[a-z]{2}\.it\.",
    r"Piazza Municipio {place} \([A-Z]{2}\)[^\n]*?utc\.{place}@cert\.it",
    r"COMUNE DI {place} \(Provincia di [^)\n]*\) Città d'Arte",
    r"COMUNE DI {place} - [A-Z0-9]+ - REG_UFF_PROT.*?Ingresso - \d{2}/\d{2}/\d{4} - \d{2}:\d{2}",
    r"COPIA CONFORME ALL'ORIGINALE DIGITALE Protocollo N\.\d+/\d{4} del \d{2}/\d{2}/\d{4} Firmatario:[^\n]*",
    r"Registro Generale N\.\s*\d+\s*DEL\s*\d{2}/\d{2}/\d{4}",
    r"L'anno \w+, il giorno \w+, del mese di \w+ nel proprio Ufficio\.",
    r"DETERMINAZIONE DEL RESPONSABILE DEL SERVIZIO N\.\s*\d+\s*DEL\s*\d{2}/\d{2}/\d{4}",
    r"PARERE DI REGOLARIT[ÀA]'? TECNICA.*?correttezza dell['’]azione amministrativa\.(?:\s*Esito:\s*Favorevole\s*Note:?)?",
    r"VISTO DI REGOLARIT[ÀA]'? CONTABILE.*?copertura finanziaria del presente atto\.(?:\s*Esito:\s*Favorevole\s*Note:?)?",
    r"ATTESTAZIONE DI CONFORMIT[ÀA]'?.*?repertorio generale dell['’]Ente\.",
    r"CERTIFICATO DI ESECUTIVIT[ÀA]'?.*?Dichiarata immediatamente eseguibile dall'Organo deliberante\.",
    r"IL PRESENTE VERBALE VIENE LETTO, APPROVATO, E SOTTOSCRITTO\.",
    r"Copia conforme all['’]originale\.",
    r"ATTESTAZIONE DI PUBBLICAZIONE ALL'ALBO PRETORIO INFORMATICO.*?IL RESPONSABILE DELLE PUBBLICAZIONI ALL'ALBO PRETORIO INFORMATICO\s*f\.to[^\n]*",
    r"{place} \([A-Z]{2}\), \d{2}/\d{2}/\d{4}\s*(?:Il Responsabile|Il Segretario|SINDACO|PRESIDENTE DEL CONSIGLIO)[^\n]*?f\.to[^\n]*",
)


def passages(places: tuple[str, ...] = ()) -> tuple[str, ...]:
    """The passages with all names of places as one alternative; without places those that need none."""
    name = "(?:" + "|".join(p.replace("'", "['’]") for p in places) + ")"
    return tuple(p.replace("{place}", name) for p in PASSAGES if places or "{place}" not in p)


def cleaned(c: str | Column, places: tuple[str, ...] = ()) -> Column:
    """Text without the passages; blanks and empty lines squeezed; null becomes empty."""
    t = F.coalesce(col(c), F.lit(""))
    for p in passages(places):
        t = F.regexp_replace(t, f"(?isu){p}", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n\s*\n+", "\n\n"), r"^\s+|\s+$", "")


def refreshed(docs: DataFrame, text: str = "text", places: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned text with its preview and measures counted again where some text is left."""
    df = docs.withColumn(text, cleaned(text, places))
    some = F.col(text) != ""
    new = {"text_preview": F.substring(text, 1, 1200), "text_chars": F.length(text).cast("bigint"), "text_words": F.size(words(text)).cast("bigint"), "unique_words": F.size(F.array_distinct(words(text))).cast("bigint")}
    return df.withColumns({k: F.when(some, v).otherwise(F.col(k) if k in docs.columns else F.lit(None)) for k, v in new.items()})
