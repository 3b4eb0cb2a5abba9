"""Session factory, table scans and lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES: list[str] = []  # intermediate tables of this process


def build_session(app: str = "scrivano", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and Arrow; `conf` overrides single settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of one Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where it is unset a local session gets one of its own;
    on a cluster that is an error, since no executor could read what another wrote."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Deletes intermediate tables; a session that has ended already leaves them."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for p in paths:
            at = jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(conf).delete(at, True)
    except Exception:  # noqa: BLE001 - at the end of the process nothing else can be done
        pass


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: cuts lineage and survives lost executors. The table is
    removed when the process ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if not TABLES:
        atexit.register(remove_tables, spark, TABLES)
    TABLES.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spark_test_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
