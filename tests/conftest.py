from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def small_blocks(spark):
    """Force centres into tiny blocks, so that every multi-block path runs."""
    key = "spark.cellwise.maxCenterBytes"

    def limit(n_bytes: int):
        spark.conf.set(key, str(n_bytes))

    yield limit
    spark.conf.unset(key)


def make_points(spark, matrix, partitions=4):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    frame = spark.createDataFrame(rows, "point_id bigint, features array<double>")
    return frame.repartition(partitions)
