"""The incremental operators as streams. Beyond the batch forms: notices and measures that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, folder: str, schema, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def new_notices(stream: DataFrame, key: str, time: str, late: str = "30 days") -> DataFrame:
    """First row of each key. Keys are kept as long as rows may come late, so the state is bounded."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, name: str, time: str, value: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Count and sum of each measure in windows of time; rows that come later than `late` are left out."""
    w = F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, name).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), name, "n", "total")
