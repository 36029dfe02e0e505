"""The alerting query: match two metrics, window them, label every window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.config import AlertRule
from hostvigil.functions import alert_label, clock_of, round_half_up
from hostvigil.operators.matching import match_readings
from hostvigil.operators.windows import (
    keep_reachable,
    window_clock_times,
    window_slices,
    window_timestamps,
)


def has_timestamps(readings: DataFrame) -> bool:
    """Whether ``ts`` holds real timestamps rather than time-of-day text."""
    return readings.schema["ts"].dataType.typeName() in ("timestamp", "timestamp_ntz")


def reachable_pair(
    left: DataFrame, right: DataFrame, rule: AlertRule
) -> tuple[DataFrame, DataFrame]:
    """Both inputs without the readings the rule's cutoff makes irrelevant.

    On time-of-day text this compares the stored column with constants, which Parquet scans
    use to skip row groups.
    """
    if has_timestamps(left) != has_timestamps(right):
        raise ValueError("one side holds times of day and the other timestamps in column ts")
    return keep_reachable(left, rule), keep_reachable(right, rule)


def window_matched(matched: DataFrame, rule: AlertRule) -> DataFrame:
    """Raw aggregates per (server, window)."""
    if not has_timestamps(matched):
        return window_clock_times(matched, rule)
    return (window_timestamps if matched.isStreaming else window_slices)(matched, rule)


def metric_windows(left: DataFrame, right: DataFrame, rule: AlertRule) -> DataFrame:
    """Raw aggregates of both metrics per (server, window), cutoff applied."""
    left, right = reachable_pair(left, right, rule)
    return window_matched(match_readings(left, right, rule), rule)


def label_windows(windows: DataFrame, rule: AlertRule) -> DataFrame:
    """Rounded aggregates and the alert text next to the window bounds."""
    left, right = rule.left.output, rule.right.output
    rounded = windows.select(
        "server_id",
        "window_start",
        "window_end",
        round_half_up(F.col("left_raw")).alias(left),
        round_half_up(F.col("right_raw")).alias(right),
    )
    return rounded.withColumn("alert", alert_label(F.col(left), F.col(right), rule))


def format_alerts(labelled: DataFrame, rule: AlertRule, ordered: bool = False) -> DataFrame:
    """The alert table, window bounds as time-of-day text.

    Ordering is by server and window text; windows that print alike (just before midnight of
    two days) follow each other in real order.
    """
    if ordered:
        labelled = labelled.orderBy("server_id", clock_of(F.col("window_start")), "window_start")
    return labelled.select(
        "server_id",
        clock_of(F.col("window_start")).alias("window_start"),
        clock_of(F.col("window_end")).alias("window_end"),
        rule.left.output,
        rule.right.output,
        "alert",
    )


def alerts(
    left: DataFrame, right: DataFrame, rule: AlertRule, ordered: bool = False
) -> DataFrame:
    """The whole query, from two tables of readings to the alert table."""
    return format_alerts(label_windows(metric_windows(left, right, rule), rule), rule, ordered)
