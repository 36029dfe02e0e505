"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from hostvigil.session import build_session  # noqa: E402


def local_session() -> SparkSession:
    """A small local session in UTC."""
    spark = build_session("hostvigil tests", **{
        "spark.master": "local[8]",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.shuffle.partitions": "4",
    })
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session()
    yield session
    session.stop()
