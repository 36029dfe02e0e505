"""Sliding windows per server over matched readings.

Two plans for the same result:

``window_clock_times`` is for time-of-day readings (whole seconds). It cuts the day into blocks,
copies the few readings whose windows start in the block before, and shuffles once by
(server, block). All windows of a block are then complete within one partition, so each reading
is copied to its windows after the shuffle instead of before it: about 1 row shuffled per reading
instead of size / slide. A block holds at most one row per second, whatever the input size.

``window_slices`` is for real timestamps in batch. Nothing bounds the number of distinct timestamps
in a block, but the slices of a window (as long as the common divisor of size and slide) are
bounded. Readings are aggregated to slices first, partially before the shuffle; slices are then
placed in blocks and form windows there, as above.

``window_timestamps`` groups by ``F.window`` directly, which is what streams keep state for.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.config import DAY_SECONDS, AlertRule, clock_seconds, clock_text
from hostvigil.functions import day_second, second_of_day
from hostvigil.operators.matching import merge_partials, merged_value, weigh

# Window lengths per block: at 20, a thirtieth of the readings are copied.
BLOCK_WINDOWS = 20


def keep_reachable(readings: DataFrame, rule: AlertRule) -> DataFrame:
    """Drop readings that cannot fall in any window kept by the rule's cutoff.

    Kept windows start at the cutoff or later, so they hold readings from the cutoff on and,
    across midnight, from the start of the next day. Time-of-day text is compared as it is
    stored, timestamps by their second of the day.
    """
    if rule.cutoff is None or rule.crossing_seconds >= DAY_SECONDS:
        return readings
    ts = F.col("ts")
    if readings.schema["ts"].dataType.typeName() == "string":
        return readings.filter((ts >= rule.cutoff) | (ts < clock_text(rule.crossing_seconds)))
    second = day_second(ts)
    return readings.filter(
        (second >= clock_seconds(rule.cutoff)) | (second < rule.crossing_seconds)
    )


def _finish(windows: DataFrame, rule: AlertRule, start: Column, end: Column) -> DataFrame:
    return windows.select(
        "server_id",
        start.alias("window_start"),
        end.alias("window_end"),
        merged_value("left", rule).alias("left_raw"),
        merged_value("right", rule).alias("right_raw"),
    )


def _wall_clock(seconds: Column) -> Column:
    """Seconds relative to 1970-01-01 00:00:00 as a timestamp without time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def block_seconds(rule: AlertRule) -> int:
    """How much of the day a block covers."""
    return BLOCK_WINDOWS * rule.size_seconds


def blocks_of(second: Column, rule: AlertRule) -> Column:
    """The blocks in which windows of a second of the day start."""
    length = block_seconds(rule)
    into_block = F.pmod(second, F.lit(length))
    own_block = second - into_block
    # A reading's earliest window starts less than one size before it.
    return F.when(
        into_block < rule.size_seconds, F.array(own_block, own_block - length)
    ).otherwise(F.array(own_block))


def window_clock_times(matched: DataFrame, rule: AlertRule) -> DataFrame:
    """Windows of readings whose ``ts`` is time-of-day text; unreadable times are dropped."""
    read = second_of_day(F.col("ts"))
    # Unreadable times have no block, so they end at the explode. A filter for them would be
    # pushed below the matching and read every reading's time instead of every matched key's.
    weighed = weigh(
        matched, rule, F.col("server_id"), read.isNotNull().alias("readable"),
        F.coalesce(read, F.lit(0)).alias("second"),
    )
    blocks = F.when(F.col("readable"), blocks_of(F.col("second"), rule)).otherwise(
        F.array().cast("array<bigint>")
    )
    placed = weighed.withColumn("block", F.explode(blocks)).repartition("server_id", "block")
    return windows_in_blocks(placed, rule)


def windows_in_blocks(placed: DataFrame, rule: AlertRule) -> DataFrame:
    """Windows of weighed readings (server_id, block, second, ...) that lie in all blocks in which
    their windows start; no shuffle if they are dealt by server and block."""
    size, slide = rule.size_seconds, rule.slide_seconds
    second, start = F.col("second"), F.col("start")
    latest = second - F.pmod(second, F.lit(slide))
    starts = F.array(*(latest - step * slide for step in range(-(-size // slide))))
    kept = (start > second - size) & (
        start - F.pmod(start, F.lit(block_seconds(rule))) == F.col("block")
    )
    if rule.cutoff is not None:
        kept &= F.pmod(start, F.lit(DAY_SECONDS)) >= clock_seconds(rule.cutoff)
    windows = (
        placed.withColumn("start", F.explode(starts))
        .filter(kept)
        .groupBy("server_id", "block", "start")
        .agg(*merge_partials(rule))
    )
    return _finish(windows, rule, _wall_clock(start), _wall_clock(start + size))


def _tumbling(timestamp: str, seconds: int) -> Column:
    """Start of the interval of so many seconds that a timestamp lies in."""
    return F.window(F.col(timestamp), f"{seconds} seconds")["start"]


def window_slices(matched: DataFrame, rule: AlertRule) -> DataFrame:
    """Windows of readings whose ``ts`` is a real timestamp, in batch."""
    size, slide = rule.size_seconds, rule.slide_seconds
    block_length = block_seconds(rule)
    length = F.make_dt_interval(secs=F.lit(size))
    back = F.make_dt_interval(secs=F.lit(block_length))
    slices = (
        weigh(matched, rule, F.col("server_id"), F.col("ts"))
        .withColumn("slice", _tumbling("ts", gcd(size, slide)))
        .groupBy("server_id", "slice")
        .agg(*merge_partials(rule))
    )
    own = F.col("own")
    # A slice's earliest window starts less than one size before it.
    blocks = F.when(F.col("slice") < own + length, F.array(own, own - back)).otherwise(F.array(own))
    placed = (
        slices.withColumn("own", _tumbling("slice", block_length))
        .withColumn("block", F.explode(blocks))
        .repartition("server_id", "block")
    )
    # All readings of a slice lie in the same windows.
    latest = F.col("latest")
    starts = F.array(
        *(latest - F.make_dt_interval(secs=F.lit(k * slide)) for k in range(-(-size // slide)))
    )
    start = F.col("start")
    kept = start + length > F.col("slice")
    if rule.cutoff is not None:
        kept &= day_second(start) >= clock_seconds(rule.cutoff)
    windows = (
        placed.withColumn("latest", _tumbling("slice", slide))
        .withColumn("start", F.explode(starts))
        .filter(kept)
        .withColumn("start_block", _tumbling("start", block_length))
        .filter(F.col("start_block") == F.col("block"))
        .groupBy("server_id", "block", "start")
        .agg(*merge_partials(rule))
    )
    return _finish(windows, rule, start, start + length)


def window_timestamps(matched: DataFrame, rule: AlertRule) -> DataFrame:
    """Windows of readings whose ``ts`` is a real timestamp; works on streams."""
    window = F.window(F.col("ts"), f"{rule.size_seconds} seconds", f"{rule.slide_seconds} seconds")
    weighed = weigh(matched, rule, F.col("server_id"), F.col("ts"))
    windows = weighed.groupBy("server_id", window).agg(*merge_partials(rule))
    if rule.cutoff is not None:
        windows = windows.filter(day_second(F.col("window.start")) >= clock_seconds(rule.cutoff))
    return _finish(windows, rule, F.col("window.start"), F.col("window.end"))
