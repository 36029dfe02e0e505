"""Counts and the earliest time, gathered while a plan runs or as tables of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hostvigil.config import AlertRule
from hostvigil.operators.matching import group_readings, joined_rows
from hostvigil.operators.quarantine import readable_time


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without a pass of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _summary(grouped: DataFrame) -> list[Column]:
    """Readings of either side, unreadable ones among them, joined rows, earliest joined time.

    Readings without a usable time or server count as readings but join nothing.
    """
    read = readable_time(grouped)
    joined = (
        (F.col("left_rows") > 0)
        & (F.col("right_rows") > 0)
        & F.col("server_id").isNotNull()
        & read
    )
    return [
        F.sum("left_rows").alias("left_records"),
        F.sum("right_rows").alias("right_records"),
        F.sum(F.when(~read, F.col("left_rows"))).alias("left_bad_times"),
        F.sum(F.when(~read, F.col("right_rows"))).alias("right_bad_times"),
        F.sum(F.when(joined, joined_rows())).alias("joined_records"),
        F.min(F.when(joined, F.col("ts"))).alias("earliest"),
    ]


def observe_groups(grouped: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The summary of grouped readings, gathered as they pass."""
    seen = Observation(name)
    return grouped.observe(seen, *_summary(grouped)), seen


def count_by_topic(records: DataFrame) -> DataFrame:
    """Messages per topic."""
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def pair_summary(left: DataFrame, right: DataFrame, rule: AlertRule) -> DataFrame:
    """One row: readings of either side, joined rows, and the earliest joined time.

    Counts are null without readings.
    """
    grouped = group_readings(left, right, rule)
    return grouped.agg(*_summary(grouped)).select(
        "left_records", "right_records", F.col("joined_records").cast("long"), "earliest"
    )
