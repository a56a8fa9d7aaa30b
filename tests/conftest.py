from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpuscope.session import tuned


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = tuned(
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def notes(spark):
    """Build a notes frame from (doc_id, transcription, medical_specialty) rows."""

    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, transcription string, medical_specialty string")

    return build
