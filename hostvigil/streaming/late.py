"""Readings that come behind the watermark: a side table, and corrections of what they touch.

The alert stream drops a reading whose time the watermark has passed. ``windows_and_late`` emits
such readings beside the windows, in the same query, because only the query that drops them knows
its watermark. A batch job then recomputes the windows that they touch, and no others, from all
readings that were landed; corrections are appended and the newest one of a window counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hostvigil.config import AlertRule, clock_seconds
from hostvigil.functions import day_second
from hostvigil.operators.matching import match_readings
from hostvigil.plans.alerts import label_windows, metric_windows, window_matched
from hostvigil.streaming.continuous import watermarked

WINDOW, LATE = "window", "late"
#: Groups that a batch's readings are looked through in; they keep nothing from batch to batch.
SHARDS = 256


def _behind(
    _key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """The rows of a batch that the watermark has passed."""
    passed = state.getCurrentWatermarkMs()
    for frame in frames:
        found = frame.loc[(frame["ms"] <= passed) & ~frame["is_beat"], ["topic", "server_id", "ts"]]
        if len(found):
            yield found


def late_readings(left: DataFrame, right: DataFrame, rule: AlertRule) -> DataFrame:
    """(topic, server_id, ts) of the readings of two watermarked streams that come too late.

    The watermark is at least the one the windows drop readings by, so none of those is missing;
    a few may be among them that did count, and correcting their windows changes nothing.
    Heartbeats are passed over only here: a filter would take them away before the watermark, and
    the query's watermark is that of its slowest part.
    """
    sides = [
        readings.filter(F.col("server_id").isNotNull()).select(
            F.lit(side.topic).alias("topic"), "server_id", "ts",
            (F.col("is_beat") if "is_beat" in readings.columns else F.lit(False)).alias("is_beat"),
            F.unix_millis("ts").alias("ms"),
            F.pmod(F.xxhash64("server_id", "ts"), F.lit(SHARDS)).alias("shard"),
        )
        for readings, side in ((left, rule.left), (right, rule.right))
    ]
    return sides[0].unionByName(sides[1]).groupBy("shard").applyInPandasWithState(
        _behind, "topic string, server_id string, ts timestamp", "nothing int", "append",
        GroupStateTimeout.NoTimeout,
    )


def windows_and_late(
    left: DataFrame, right: DataFrame, rule: AlertRule, delay: str = "30 seconds",
    beats: DataFrame | None = None,
) -> DataFrame:
    """Closed windows and late readings of two streams as one, told apart by ``kind``.

    Write it with ``start_alerts(..., partition_by=("kind",))``.
    """
    pair = watermarked(left, right, delay, beats)
    windows = label_windows(metric_windows(*pair, rule), rule)
    late = late_readings(*pair, rule)
    return windows.withColumn("kind", F.lit(WINDOW)).unionByName(
        late.withColumn("kind", F.lit(LATE)), allowMissingColumns=True
    )


def read_windows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The windows of a table written from :func:`windows_and_late`."""
    rows = spark.read.schema(schema).parquet(path).filter(F.col("kind") == WINDOW)
    return rows.drop("kind", "topic", "ts")


def read_late(spark: SparkSession, path: str, schema) -> DataFrame:
    """The late readings of such a table."""
    rows = spark.read.schema(schema).parquet(path).filter(F.col("kind") == LATE)
    return rows.select("topic", "server_id", "ts")


def _floor(ts: Column, seconds: int) -> Column:
    return F.window(ts, f"{seconds} seconds")["start"]


def touched_windows(late: DataFrame, rule: AlertRule) -> DataFrame:
    """The (server_id, window_start) that late readings lie in, each once, cutoff applied."""
    size, slide = rule.size_seconds, rule.slide_seconds
    window = F.window("ts", f"{size} seconds", f"{slide} seconds")
    starts = late.select("server_id", window.alias("window")).select(
        "server_id", F.col("window.start").alias("window_start")
    )
    if rule.cutoff is not None:
        starts = starts.filter(day_second(F.col("window_start")) >= clock_seconds(rule.cutoff))
    return starts.distinct()


def corrected_windows(
    late: DataFrame, left: DataFrame, right: DataFrame, rule: AlertRule
) -> DataFrame:
    """The windows that late readings touch, computed anew from all readings of both sides.

    Of the readings only those in slices of touched windows go past the first join, whose other
    side is a few rows per late reading. Windows those slices only graze are left out again.
    """
    touched = touched_windows(late, rule)
    size, part = rule.size_seconds, gcd(rule.size_seconds, rule.slide_seconds)
    starts = F.array(
        *(F.col("window_start") + F.make_dt_interval(secs=F.lit(k)) for k in range(0, size, part))
    )
    slices = touched.select("server_id", F.explode(starts).alias("slice")).distinct()

    def within(readings: DataFrame) -> DataFrame:
        stamped = readings.withColumn("ts", F.col("ts").cast("timestamp"))
        sliced = stamped.withColumn("slice", _floor(F.col("ts"), part))
        return sliced.join(slices, ["server_id", "slice"], "left_semi").drop("slice")

    matched = match_readings(within(left), within(right), rule)
    windows = label_windows(window_matched(matched, rule), rule)
    return windows.join(touched, ["server_id", "window_start"], "left_semi").select(
        *windows.columns
    )


def add_corrections(corrected: DataFrame, path: str, run: int) -> None:
    """Append corrected windows under the number of the run that made them, later runs higher."""
    corrected.withColumn("run", F.lit(run).cast("long")).write.mode("append").parquet(path)


def latest_windows(emitted: DataFrame, corrections: DataFrame) -> DataFrame:
    """Every window once: as corrected last, else as the stream emitted it."""
    names = emitted.columns
    both = emitted.withColumn("run", F.lit(-1).cast("long")).unionByName(corrections)
    row = F.max_by(F.struct(*names), "run").alias("row")
    return both.groupBy("server_id", "window_start").agg(row).select("row.*")
