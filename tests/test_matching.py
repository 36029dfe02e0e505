"""Matching against the plain join, row by row."""

from __future__ import annotations

from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bench import join_readings
from hostvigil.config import CPU_MEM, NET_DISK
from hostvigil.operators.counts import count_by_topic, pair_summary
from hostvigil.operators.matching import (
    joined_rows,
    match_readings,
    merged_value,
    weigh,
)
from hostvigil.operators.preview import first_rows
from hostvigil.plans.alerts import alerts, metric_windows

READING = "ts string, server_id string, {0} {1}"


def tables(spark, rule, left, right):
    return tuple(
        spark.createDataFrame(rows, READING.format(side.metric, side.metric_type))
        for rows, side in ((left, rule.left), (right, rule.right))
    )


def test_repeated_keys_weigh_averages(spark):
    left = [("20:53:00", "s", 10.0), ("20:53:00", "s", 20.0), ("20:53:05", "s", 60.0)]
    right = [("20:53:00", "s", 1.0)] * 3 + [("20:53:05", "s", 7.0)]
    pair = tables(spark, CPU_MEM, left, right)
    assert join_readings(*pair, CPU_MEM).count() == 7
    matched = match_readings(*pair, CPU_MEM)
    assert sorted(int(r[0]) for r in matched.select(joined_rows()).collect()) == [1, 6]
    window = alerts(*pair, CPU_MEM).filter("window_start = '20:53:00'").first()
    assert window.avg_cpu == round((3 * 10 + 3 * 20 + 60) / 7, 2)
    assert window.avg_mem == round((6 * 1 + 7) / 7, 2)


def test_unmatched_and_null_keys_are_dropped(spark):
    left = [("20:53:00", "s", 1.0), ("20:53:05", "s", 1.0), (None, "s", 1.0), ("20:53:00", None, 1.0),
            ("bad", "s", 1.0)]
    right = [("20:53:00", "s", 2.0), ("20:53:10", "s", 2.0), (None, "s", 2.0),
             ("20:53:00", None, 2.0), ("bad", "s", 2.0)]
    pair = tables(spark, CPU_MEM, left, right)
    got = metric_windows(*pair, CPU_MEM).collect()
    assert [(r.server_id, r.left_raw, r.right_raw) for r in got] == [("s", 1.0, 2.0)]


def test_null_metrics_count_as_rows_but_not_as_values(spark):
    left = [("20:53:00", "s", None), ("20:53:01", "s", 4.0)]
    right = [("20:53:00", "s", 8.0), ("20:53:01", "s", None), ("20:53:01", "s", None)]
    for rule in (CPU_MEM, NET_DISK):
        row = metric_windows(*tables(spark, rule, left, right), rule).first()
        assert (row.left_raw, row.right_raw) == (4.0, 8.0)
    nothing = metric_windows(
        *tables(spark, CPU_MEM, [("20:53:00", "s", None)], [("20:53:00", "s", 99.0)]), CPU_MEM
    )
    assert [(r.left_raw, r.right_raw) for r in nothing.collect()] == [(None, 99.0)]


def test_joined_row_counts_beyond_a_long(spark):
    huge = spark.createDataFrame([(4 * 10**12, 4 * 10**12)], "left_rows long, right_rows long")
    assert int(huge.select(joined_rows()).first()[0]) == 16 * 10**24


def test_hot_key_never_becomes_pairs(spark):
    """Half a million readings of one key on either side: 2.5e11 joined rows, none built."""
    rows = spark.range(500_000)
    ts = F.lit("20:53:00").alias("ts")
    server = F.lit("s").alias("server_id")
    cpu = rows.select(ts, server, (F.col("id") % 100).cast("float").alias("cpu_pct"))
    mem = rows.select(ts, server, (F.col("id") % 10).cast("float").alias("mem_pct"))
    summary = pair_summary(cpu, mem, CPU_MEM).first()
    assert summary.joined_records == 250_000_000_000
    assert summary.earliest == "20:53:00"
    window = alerts(cpu, mem, CPU_MEM).first()
    assert (window.avg_cpu, window.avg_mem) == (49.5, 4.5)


def test_summary_counts_unusable_readings_as_readings(spark):
    left = [("20:53:00", "s", 1.0), ("bad", "s", 1.0), (None, "s", 1.0)]
    right = [("20:53:00", "s", 1.0), ("20:53:00", "s", 1.0), ("bad", "s", 1.0)]
    got = pair_summary(*tables(spark, CPU_MEM, left, right), CPU_MEM).first()
    assert tuple(got) == (3, 3, 2, "20:53:00")


def test_count_by_topic_and_preview(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("a", 2)], "topic string, x int")
    assert {tuple(r) for r in count_by_topic(df).collect()} == {("a", 2), ("b", 1)}
    assert [r.x for r in first_rows(df, 2, "x").collect()] == [1, 2]
    assert first_rows(df, 2).count() == 2


def test_unknown_aggregate_is_refused():
    with pytest.raises(ValueError):
        replace(CPU_MEM, aggregate="median")


readings = st.lists(
    st.tuples(
        st.sampled_from(["20:53:00", "20:53:04", "20:53:29", "00:00:05", "23:59:58", "bad", None]),
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(-400, 400).map(lambda n: n / 4)),
    ),
    max_size=14,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=readings, right=readings, rule=st.sampled_from([CPU_MEM, NET_DISK]))
def test_matching_equals_the_plain_join(spark, left, right, rule):
    pair = tables(spark, rule, left, right)
    function = F.avg if rule.aggregate == "avg" else F.max
    plain = (
        join_readings(*pair, rule)
        .groupBy("ts", "server_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            function(rule.left.metric).cast("double").alias("a"),
            function(rule.right.metric).cast("double").alias("b"),
        )
    )
    matched = weigh(
        match_readings(*pair, rule), rule, F.col("ts"), F.col("server_id"),
        joined_rows().cast("long").alias("n"),
    ).select("ts", "server_id", "n", merged_value("left", rule), merged_value("right", rule))
    assert {tuple(r) for r in matched.collect()} == {tuple(r) for r in plain.collect()}
