"""Separating usable rows from rows that carry a problem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.config import AlertRule
from hostvigil.functions import second_of_day
from hostvigil.schemas import WIDE


def usable(checked: DataFrame) -> DataFrame:
    """Wide rows without a problem."""
    return checked.filter(F.col("problem").isNull()).select(*WIDE.names)


def quarantined(checked: DataFrame) -> DataFrame:
    """What was refused and why."""
    return checked.filter(F.col("problem").isNotNull()).select("problem", "raw")


def readable_time(readings: DataFrame) -> Column:
    """Whether ``ts`` is a timestamp, or text that is a time of day."""
    ts = F.col("ts")
    is_text = readings.schema["ts"].dataType.typeName() == "string"
    return (second_of_day(ts) if is_text else ts).isNotNull()


def mark_bad_times(readings: DataFrame) -> DataFrame:
    """Add a ``problem`` to readings whose time cannot be read."""
    return readings.withColumn("problem", F.when(~readable_time(readings), "bad_time"))


def bad_times(left: DataFrame, right: DataFrame, rule: AlertRule) -> DataFrame:
    """The readings of either side whose time cannot be read, as (topic, ts, server_id, value)."""
    sides = [
        mark_bad_times(side).filter(F.col("problem").isNotNull()).select(
            F.lit(spec.topic).alias("topic"), F.col("ts").cast("string"), "server_id",
            F.col(spec.metric).cast("string").alias("value"), "problem",
        )
        for side, spec in ((left, rule.left), (right, rule.right))
    ]
    return sides[0].unionByName(sides[1])


def count_problems(checked: DataFrame) -> DataFrame:
    """Rows per problem, accepted rows under ``ok``."""
    return checked.groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(
        F.count(F.lit(1)).alias("n")
    )
