"""Heartbeats: times that let windows close where no readings come any more.

A watermark moves with readings only, and with the slower of two topics, so a topic that falls
silent leaves the last windows of both open. Beats are a stream of their own, unioned to both
sides before the watermark: rows without readings, as late as the clock less an idle time. Nothing
they touch is counted. They are written only once readings are missing, so a backlog of any age is
read first; readings that come after all for windows closed by a beat are late ones, see ``late``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_SCHEMA = "ts timestamp"


def open_beats(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of the beats written to a folder, which is made if it is missing."""
    spark.createDataFrame([], _SCHEMA).coalesce(1).write.mode("ignore").parquet(folder)
    return spark.readStream.schema(_SCHEMA).parquet(folder)


def beat(spark: SparkSession, folder: str, idle_seconds: float) -> None:
    """Write a beat: whatever is older than the idle time may close."""
    back = F.make_dt_interval(secs=F.lit(float(idle_seconds)).cast("decimal(18,6)"))
    row = spark.range(1).select((F.current_timestamp() - back).cast("timestamp").alias("ts"))
    row.coalesce(1).write.mode("append").parquet(folder)


def with_beats(readings: DataFrame, beats: DataFrame) -> DataFrame:
    """Readings and beats under one time column; ``is_beat`` tells them apart.

    Beats have an empty server rather than none, as rows without a server are dropped below the
    watermark already.
    """
    marked = beats.select(
        F.col("ts").cast(readings.schema["ts"].dataType), F.lit("").alias("server_id"),
        F.lit(True).alias("is_beat"),
    )
    return readings.withColumn("is_beat", F.lit(False)).unionByName(
        marked, allowMissingColumns=True
    )


def drain_and_close(
    spark: SparkSession, start: Callable[[], StreamingQuery], folder: str, idle_seconds: float = 0
) -> None:
    """Run a query that ends by itself until its sources are empty, then once more with a beat.

    The second run takes up the first one's state, so what the beat closes is emitted then.
    """
    start().awaitTermination()
    beat(spark, folder, idle_seconds)
    start().awaitTermination()


class SilenceWatch:
    """Which sources of a running query have had no rows for how long, by its progress reports."""

    def __init__(self, now: float, ignored: str):
        self.ignored = ignored
        self.began = now
        self.seen: dict[str, float] = {}
        self.batches: set[int] = set()

    def look(self, reports: list, now: float) -> float:
        """Seconds since the source that has been silent longest had rows."""
        for report in reports:
            for number, source in enumerate(report.sources):
                # A source has no name; its place in the plan tells those of one description apart.
                name = f"{number} {source.description}"
                if self.ignored in source.description:
                    continue
                self.seen.setdefault(name, self.began)
                if source.numInputRows and report.batchId not in self.batches:
                    self.seen[name] = now
        self.batches |= {report.batchId for report in reports}
        return now - min(self.seen.values(), default=now)


def await_closing(
    spark: SparkSession, query: StreamingQuery, folder: str, idle_seconds: float,
    poll_seconds: float = 5,
) -> None:
    """Wait for a continuous query, writing a beat whenever a topic has been silent long enough.

    At most one beat per idle time, and none while all topics have readings.
    """
    watch, last = SilenceWatch(time.monotonic(), folder), -float("inf")
    while not query.awaitTermination(poll_seconds):
        now = time.monotonic()
        silent = watch.look(query.recentProgress, now)
        if silent >= idle_seconds and now - last >= idle_seconds:
            beat(spark, folder, idle_seconds)
            last = now
