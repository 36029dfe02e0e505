"""Scalar expressions on hand-made values."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from hostvigil.config import CPU_MEM, NET_DISK, clock_seconds, clock_text, load_thresholds
from hostvigil.functions import (
    alert_label,
    clock_of,
    finite_number,
    is_number_text,
    round_half_up,
    second_of_day,
    time_of_day,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, expression):
    return [row[1] for row in df.select("i", expression).orderBy("i").collect()]


def test_time_of_day_reads_only_full_padded_times(spark):
    bad = ["bad", "2024-01-01 20:53:00", "8:05:00", "24:00:00", "20:53", "", "20:53:00 ", None]
    df = column(spark, ["20:53:00", "00:00:00", "23:59:59", *bad])
    assert results(df, clock_of(time_of_day(F.col("v")))) == [
        "20:53:00", "00:00:00", "23:59:59", *[None] * len(bad),
    ]


def test_second_of_day_reads_the_same_texts(spark):
    texts = ["20:53:00", "00:00:00", "23:59:59", "bad", "8:05:00", "24:00:00", "20:53", "", None,
             "20:53:00 ", " 20:53:00", "20:53:00\n", "20:53:60", "20-53-00", "20:53:0Z",
             "2024-01-01 20:53:00", "\u0662\u0660:53:00"]
    df = column(spark, texts)
    got = results(df, second_of_day(F.col("v")))
    assert got[:3] == [75180, 0, 86399] and got[3:] == [None] * (len(texts) - 3)
    assert [s is None for s in got] == [t is None for t in results(df, time_of_day(F.col("v")))]


def test_rounding_is_half_up(spark):
    df = column(spark, [75.685, 75.695, 2.675, 0.125, -0.125, math.nan], "double")
    got = results(df, round_half_up(F.col("v")))
    assert got[:-1] == [75.69, 75.7, 2.68, 0.13, -0.13]
    assert math.isnan(got[-1])


@pytest.mark.parametrize("rule", [CPU_MEM, NET_DISK], ids=lambda rule: rule.name)
def test_labels(spark, rule):
    a, b = rule.left.threshold, rule.right.threshold
    high, low, nan = 1e6, 1.0, math.nan
    cases = [
        (high, high, rule.both_label),
        (high, low, rule.left_label),
        (low, high, rule.right_label),
        (low, low, ""),
        (a, b, ""),
        (None, high, ""),
        (high, None, ""),
        (None, None, ""),
        (nan, low, rule.left_label),
        (low, nan, rule.right_label),
        (math.inf, low, rule.left_label),
    ]
    df = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(cases)],
                               "i int, x double, y double")
    assert results(df, alert_label(F.col("x"), F.col("y"), rule)) == [c[2] for c in cases]


def test_numbers_in_records_become_finite_or_null(spark):
    texts = ["1.5", " 2 ", "-1e3", "NaN", "Infinity", "-inf", "abc", "", None]
    assert results(column(spark, texts), finite_number(F.col("v"))) == [
        1.5, 2.0, -1000.0, *[None] * 6,
    ]


def test_number_text(spark):
    good = ["1", "-1.5", "+.5", "5.", "1e-3", " 7 ", "nan", "-Infinity", "INF"]
    bad = ["", "abc", "1d", "1f", "0x1p3", "1,5", "1 2", "e5", "."]
    df = column(spark, good + bad)
    assert results(df, is_number_text(F.col("v"))) == [True] * len(good) + [False] * len(bad)


def test_clock_text_and_seconds():
    assert clock_seconds("20:53:00") == 75180
    assert clock_text(75180) == "20:53:00"
    with pytest.raises(ValueError):
        clock_seconds("8:05:00")


def test_thresholds_file(spark, tmp_path):
    path = tmp_path / "limits.txt"
    path.write_text("cpu_threshold: 10.5\ndisk_io_threshold: 7\n\n")
    rules = load_thresholds(spark, str(path))
    assert rules["cpu_mem"] == CPU_MEM.with_thresholds(left=10.5)
    assert rules["net_disk"] == NET_DISK.with_thresholds(right=7)
    path.write_text("gpu_threshold: 1\n")
    with pytest.raises(ValueError):
        load_thresholds(spark, str(path))


def test_standard_thresholds():
    limits = [s.threshold for r in (CPU_MEM, NET_DISK) for s in (r.left, r.right)]
    assert limits == [75.69, 74.28, 6477.4, 1176.57]
