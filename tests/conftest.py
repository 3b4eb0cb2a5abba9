import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", sys.path[0])


@pytest.fixture(scope="session")
def spark():
    from scrivano.session import build_session

    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="spark-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-")}
    )
    yield session
    session.stop()
