"""Sinks: tables, texts, reports, appended notices."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tables(tables: dict[str, DataFrame], folder: str, form: str = "parquet") -> list[str]:
    """Each table into a folder of its name, cut to 31 characters as sheets are."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).format(form).save(f"{folder}/{name[:31]}")
    return sorted(n[:31] for n in tables)


def write_corpus(docs: DataFrame, folder: str, key: str = "pdf_name", text: str = "text") -> None:
    """Records as JSON lines, and their texts by name."""
    docs.write.mode("overwrite").json(f"{folder}/corpus")
    docs.select(F.col(key), F.col(text)).write.mode("overwrite").parquet(f"{folder}/texts")


def append_new(new: DataFrame, path: str) -> None:
    """Appends rows that `operators.incremental.unseen` has left."""
    new.write.mode("append").parquet(path)


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside the table and swaps the folders, since Spark cannot overwrite what it reads. The old table goes only
    when the new one stands in its place."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    fs, at = file_system(spark, path)
    new, old = file_system(spark, f"{path}.new")[1], file_system(spark, f"{path}.old")[1]
    fs.delete(old, True)
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        fs.rename(old, at)
        raise OSError(f"cannot move {path}.new to its place")
    fs.delete(old, True)


def write_text(text: str, path: str, spark: SparkSession | None = None) -> None:
    """A small text, on whatever file system the path names."""
    fs, at = file_system(spark or SparkSession.active(), path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def export_measures(points: DataFrame, operations: DataFrame, folder: str, time: str = "recorded_at") -> None:
    """The last 1000 points and the last 100 operations as JSON."""
    points.orderBy(F.desc(time)).limit(1000).coalesce(1).write.mode("overwrite").json(f"{folder}/points")
    operations.orderBy(F.desc(time)).limit(100).coalesce(1).write.mode("overwrite").json(f"{folder}/operations")
