from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from ledgerloom.session import CLUSTER_CONF

    home = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(home / "checkpoint"))
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Local rows as a DataFrame."""
    from ledgerloom.sources.tables import local_table

    return lambda ddl, data: local_table(spark, ddl, data)
