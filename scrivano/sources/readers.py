"""Scans: CSV, JSON lines, texts and files, with explicit schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOTICE = "page_url STRING, titolo STRING, numero STRING, data_pubblicazione STRING, tipologia STRING, ufficio STRING, oggetto STRING, dettaglio_url STRING, allegati STRING"


def read_csv(spark: SparkSession, path: str, schema: str = NOTICE) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', enforceSchema=False)


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; the word NaN of a category, as some writers leave it, is null."""
    df = spark.read.schema(schema).option("allowNonNumericNumbers", True).json(path)
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    return df.select(*(F.nullif(F.col(c), F.lit("NaN")).alias(c) if c in texts else F.col(c) for c in df.columns))


def with_columns(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Adds the expected columns that are missing, as nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in expected.items() if c not in df.columns})


def checked_table(spark: SparkSession, path: str, required: list[str], form: str = "parquet") -> tuple[DataFrame | None, list[str]]:
    """The table, or None with what is wrong with it."""
    try:
        df = spark.read.format(form).option("header", True).load(path)
        lacking = sorted(set(required) - set(df.columns))
    except Exception as e:
        return None, [f"{path}: {type(e).__name__}"]
    return df, [f"{path}: column {c} is missing" for c in lacking]


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of every text file of a folder."""
    return spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_files(spark: SparkSession, folder: str, endings: tuple[str, ...] = ("pdf", "php", "p7m")) -> DataFrame:
    """(path, length, content) of the documents of a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(endings) + "}").load(folder).select("path", "length", "content")


def fingerprints(files: DataFrame) -> DataFrame:
    """Manifest rows (name, size, sha256) of files."""
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def same_manifest(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def quarantine(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that begin as PDF, and the others with a reason."""
    good = F.substring("content", 1, 4) == F.lit(b"%PDF")
    return files.filter(good), files.filter(~good).select("path", F.lit("missing_pdf_signature").alias("reason"))


def file_texts(files: DataFrame, read: Callable[[bytes], str]) -> DataFrame:
    """(path, text, reason) by a given reader of bytes. Errors of a file become its reason; they do not end the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, c in zip(pdf["path"], pdf["content"]):
                try:
                    rows.append((p, read(bytes(c)), None))
                except Exception as e:
                    rows.append((p, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "text", "reason"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, reason string")
