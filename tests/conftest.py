import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark import SparkConf, SparkContext  # noqa: E402

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    SparkContext._ensure_initialized()  # so that the settings of spark-defaults are known
    unset = SparkConf().get("spark.checkpoint.dir") is None
    own = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))} if unset else {}
    session = build_session(
        "tidemark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            **own,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
