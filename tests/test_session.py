from types import SimpleNamespace

import pytest

from scrivano import session
from scrivano.sources import writers


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None)
    with pytest.raises(ValueError):
        session.shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
    assert session.shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]"))).startswith("file:///")


def test_written_tables_are_removed(spark, tmp_path):
    df = session.written(spark.range(5), "five")
    path = session.TABLES[-1]
    assert df.count() == 5 and "five-" in path
    session.remove_tables(spark, [path])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_replaced_table_and_texts(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_table(spark.range(3), path)
    writers.replace_table(spark.read.parquet(path).selectExpr("id + 10 as id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    writers.write_text("è così", f"file://{tmp_path}/r.md", spark)
    assert (tmp_path / "r.md").read_text(encoding="utf-8") == "è così"
