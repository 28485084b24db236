from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fundlens.session import with_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "4").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    builder = builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    session = with_settings(builder.config("spark.driver.memory", "4g")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
