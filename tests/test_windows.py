"""Sliding windows: hand rows, both plans, a brute-force count, and the plans' shape."""

from __future__ import annotations

import math
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostvigil.config import CPU_MEM, DAY_SECONDS, NET_DISK, clock_text
from hostvigil.functions import time_of_day
from hostvigil.operators.matching import match_readings
from hostvigil.operators.windows import window_clock_times, window_slices, window_timestamps
from hostvigil.plans.alerts import alerts, metric_windows
from hostvigil.schemas import CPU_MEM_ALERT, NET_DISK_ALERT

MIDNIGHT = datetime(1970, 1, 1)


def readings(spark, rule, rows):
    """The same (ts, server, value) rows for both sides."""
    return tuple(
        spark.createDataFrame(rows, f"ts string, server_id string, {s.metric} {s.metric_type}")
        for s in (rule.left, rule.right)
    )


def stamped(df):
    return df.withColumn("ts", time_of_day(F.col("ts")))


def starts(df, server):
    rows = df.filter(F.col("server_id") == server).orderBy("window_start").collect()
    return [(r.window_start - MIDNIGHT, r.left_raw) for r in rows]


def at(text, day=0):
    h, m, s = map(int, text.split(":"))
    return timedelta(days=day, hours=h, minutes=m, seconds=s)


HAND = [("20:53:00", "a", 1.0), ("20:53:05", "a", 2.0), ("20:53:10", "a", 4.0),
        ("00:00:05", "b", 1.0), ("23:59:45", "b", 3.0), (None, "c", 3.0)]


@pytest.mark.parametrize("convert", [lambda df: df, stamped], ids=["clock", "timestamps"])
def test_hand_rows(spark, convert):
    pair = [convert(df) for df in readings(spark, CPU_MEM, HAND)]
    windows = metric_windows(*pair, replace(CPU_MEM, cutoff=None))
    third = 7 / 3
    assert starts(windows, "a") == [
        (at("20:52:40"), 1.5), (at("20:52:50"), third), (at("20:53:00"), third),
        (at("20:53:10"), 4.0),
    ]
    midnight = [(at("23:59:40", -1), 1.0), (at("23:59:50", -1), 1.0)]
    evening = [(at("23:59:20"), 3.0), (at("23:59:30"), 3.0), (at("23:59:40"), 3.0)]
    assert starts(windows, "b") == [*midnight, (at("00:00:00"), 1.0), *evening]
    assert starts(windows, "c") == []
    lengths = {r.window_end - r.window_start for r in windows.collect()}
    assert lengths == {timedelta(seconds=30)}

    kept = metric_windows(*pair, CPU_MEM)
    assert starts(kept, "a") == [(at("20:53:00"), third), (at("20:53:10"), 4.0)]
    assert starts(kept, "b") == [*midnight, *evening]


def test_alert_table_is_formatted_labelled_and_sorted(spark):
    rows = [("20:53:00", "server_2", 80.0), ("20:53:00", "server_10", 10.0),
            ("00:00:05", "server_2", 1.0), ("23:59:45", "server_2", 3.0)]
    cpu, mem = readings(spark, CPU_MEM, rows)
    result = alerts(cpu, mem, CPU_MEM, ordered=True)
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in CPU_MEM_ALERT
    ]
    assert [tuple(r) for r in result.collect()] == [
        ("server_10", "20:53:00", "20:53:30", 10.0, 10.0, ""),
        ("server_2", "20:53:00", "20:53:30", 80.0, 80.0, "High CPU + Memory stress"),
        ("server_2", "23:59:20", "23:59:50", 3.0, 3.0, ""),
        ("server_2", "23:59:30", "00:00:00", 3.0, 3.0, ""),
        ("server_2", "23:59:40", "00:00:10", 1.0, 1.0, ""),
        ("server_2", "23:59:40", "00:00:10", 3.0, 3.0, ""),
        ("server_2", "23:59:50", "00:00:20", 1.0, 1.0, ""),
    ]
    net = alerts(*readings(spark, NET_DISK, rows), NET_DISK)
    assert [(f.name, f.dataType) for f in net.schema] == [
        (f.name, f.dataType) for f in NET_DISK_ALERT
    ]


def test_floats_are_averaged_wide_and_rounded_before_comparing(spark):
    rows = [("20:53:00", "s", 75.69)]  # as a float this is slightly above the threshold
    cpu, mem = readings(spark, CPU_MEM, rows)
    row = alerts(cpu, mem, CPU_MEM).first()
    assert (row.avg_cpu, row.alert) == (75.69, "Memory saturation suspected")


def brute_force(rows, rule):
    """Windows by definition: every start on the slide grid that covers some reading."""
    found = {}
    for clock, server, value in rows:
        if clock is None:
            continue
        second = clock
        for start in range(second - rule.size_seconds + 1, second + 1):
            if start % rule.slide_seconds == 0:
                found.setdefault((server, start), []).append(value)
    return {
        key: sum(values) / len(values)
        for key, values in found.items()
        if rule.cutoff is None or clock_text(key[1] % DAY_SECONDS) >= rule.cutoff
    }


seconds = st.one_of(
    st.integers(0, 120), st.integers(75170, 75300), st.integers(86300, 86399),
    st.integers(560, 640), st.none(),
)
rows = st.lists(
    st.tuples(seconds, st.sampled_from(["a", "b"]), st.integers(0, 400).map(lambda n: n / 4)),
    max_size=12,
    unique_by=lambda row: row[:2],  # one reading per key, so the join adds no weight
)
shapes = st.sampled_from([(30, 10), (30, 30), (25, 10), (7, 7), (60, 7), (1, 1), (90, 45)])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows, shape=shapes, cutoff=st.sampled_from(["20:53:00", "00:00:00", "23:59:30", None]))
def test_both_plans_equal_the_definition(spark, rows, shape, cutoff):
    rule = replace(CPU_MEM, size_seconds=shape[0], slide_seconds=shape[1], cutoff=cutoff)
    texts = [(None if s is None else clock_text(s), server, v) for s, server, v in rows]
    pair = readings(spark, rule, texts)
    want = brute_force(rows, rule)

    matched = match_readings(*pair, rule)
    filtered = metric_windows(*pair, rule)
    direct = metric_windows(*(stamped(df) for df in pair), rule)
    for windows in (window_clock_times(matched, rule), filtered, direct,
                    window_timestamps(stamped(matched), rule),
                    window_slices(stamped(matched), rule)):
        got = {
            (r.server_id, int((r.window_start - MIDNIGHT).total_seconds())): r.left_raw
            for r in windows.collect()
        }
        assert got.keys() == want.keys()
        assert all(math.isclose(got[key], want[key]) for key in want)


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York", "Africa/Monrovia"])
def test_session_zone_does_not_matter(spark, zone):
    cpu, mem = readings(spark, CPU_MEM, HAND)
    want = alerts(cpu, mem, CPU_MEM, ordered=True).collect()
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert alerts(cpu, mem, CPU_MEM, ordered=True).collect() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_partitioning_does_not_matter(spark):
    rows = [(clock_text(75180 + 3 * i), f"s{i % 3}", float(i % 90)) for i in range(300)]
    cpu, mem = readings(spark, CPU_MEM, rows)
    want = sorted(map(tuple, alerts(cpu, mem, CPU_MEM).collect()))
    shuffled = alerts(cpu.repartition(7), mem.orderBy(F.rand(1)).repartition(3), CPU_MEM)
    assert sorted(map(tuple, shuffled.collect())) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_two_shuffles_and_no_join(spark, tmp_path):
    rows = [(clock_text(75180 + i), "s", 1.0) for i in range(20)]
    tables = []
    for name, df in zip(("l", "r"), readings(spark, NET_DISK, rows)):
        df.withColumn("net_out", F.lit(1.0)).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    plan = plan_of(metric_windows(*tables, NET_DISK))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "Cartesian" not in plan
    assert plan.count("GreaterThanOrEqual(ts,20:53:00),LessThan(ts,00:00:20)") == 2  # pushed
    assert "net_out" not in plan  # pruned
    below_matching = plan.split("Union")[1]
    assert "RLIKE" in plan and "RLIKE" not in below_matching  # times are read after matching
    assert plan_of(alerts(*tables, NET_DISK, ordered=True)).count("Exchange") == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_slices_equal_plain_windows_of_fractional_times(spark, kind, zone):
    shapes = [(30, 10), (25, 10), (60, 7)]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        base = F.lit("2024-03-09 23:40:00").cast(kind)
        step = F.make_dt_interval(secs=F.col("id") * 1.25)
        frame = spark.range(2000).select(
            (base + step).alias("ts"), F.concat(F.lit("s"), F.col("id") % 2).alias("server_id"),
            (F.col("id") % 97).cast("double").alias("v"),
        )
        for size, slide in shapes:
            rule = replace(NET_DISK, size_seconds=size, slide_seconds=slide, cutoff="23:50:00")
            sides = [frame.withColumnRenamed("v", side.metric) for side in (rule.left, rule.right)]
            matched = match_readings(*sides, rule)
            sliced, plain = window_slices(matched, rule), window_timestamps(matched, rule)
            assert sliced.schema == plain.schema
            got = sorted(map(tuple, sliced.collect()))
            assert got == sorted(map(tuple, plain.collect())) and len(got) > 100
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_timestamp_plan_formats_no_text_and_shuffles_slices(spark):
    rows = [(clock_text(75180 + i), "s", 1.0) for i in range(20)]
    plan = plan_of(metric_windows(*(stamped(df) for df in readings(spark, NET_DISK, rows)), NET_DISK))
    assert "date_format" not in plan
    assert plan.count("Exchange hashpartitioning") == 3


def test_bad_rules_are_refused():
    for change in ({"slide_seconds": 0}, {"slide_seconds": 31}, {"cutoff": "8:05:00"}):
        with pytest.raises(ValueError):
            replace(CPU_MEM, **change)
