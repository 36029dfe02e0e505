"""Every registered query against its SQL on the smallest supplied tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as registry
from check_oracles import compare, connect
from hostvigil.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) == ""


def test_published_alerts_are_written_by_several_tasks(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = QUERIES["alerts_published"](spark, FOLDER)
    finally:
        spark.conf.set(name, before)
    assert len(found.inputFiles()) > 1


def test_a_single_file_is_one_file(spark):
    assert len(QUERIES["alerts_single_file"](spark, FOLDER).inputFiles()) == 1


def test_every_query_has_sql():
    assert QUERIES.keys() <= registry.oracle_sql().keys() <= registry.queries().keys()


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == [
        "server_id", "window_start", "window_end", "avg_cpu", "avg_mem", "alert",
    ]
    assert df.count() > 0
