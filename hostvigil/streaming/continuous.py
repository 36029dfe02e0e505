"""Alerts on streams of readings with real timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hostvigil.config import AlertRule
from hostvigil.plans.alerts import format_alerts, has_timestamps, label_windows, metric_windows
from hostvigil.streaming.heartbeat import with_beats


def watermarked(
    left: DataFrame, right: DataFrame, delay: str, beats: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both streams under a watermark, which beats move as well.

    Time-of-day text is refused: it jumps back a day at midnight, and everything after would count
    as late. Timestamps without a zone are taken to be in the session's.
    """
    for readings in (left, right):
        if not has_timestamps(readings):
            raise ValueError("continuous alerts need real timestamps in column ts")
    sides = (r.withColumn("ts", F.col("ts").cast("timestamp")) for r in (left, right))
    if beats is not None:
        sides = (with_beats(readings, beats) for readings in sides)
    left, right = (readings.withWatermark("ts", delay) for readings in sides)
    return left, right


def continuous_windows(
    left: DataFrame, right: DataFrame, rule: AlertRule, delay: str = "30 seconds",
    beats: DataFrame | None = None,
) -> DataFrame:
    """Labelled windows of two streams: one is emitted once the watermark has passed it.

    The plan is the batch one. Its two aggregations keep one row per (server, time) and per
    (server, window) in state until the watermark evicts them, never the joined pairs. Readings
    later than ``delay`` are dropped (``late`` sets them aside). The watermark is that of the
    slower side; ``beats`` (see ``heartbeat``) move it where readings are missing.
    """
    return label_windows(metric_windows(*watermarked(left, right, delay, beats), rule), rule)


def continuous_alerts(
    left: DataFrame, right: DataFrame, rule: AlertRule, delay: str = "30 seconds",
    beats: DataFrame | None = None,
) -> DataFrame:
    """The alert query over two streams, see :func:`continuous_windows`."""
    return format_alerts(continuous_windows(left, right, rule, delay, beats), rule)


def start_alerts(
    alert_stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append alerts to files as their windows close."""
    writer = (
        alert_stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
