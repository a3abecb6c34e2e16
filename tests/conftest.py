from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestream.session import drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lakestream-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()
