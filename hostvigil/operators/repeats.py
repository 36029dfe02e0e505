"""De-duplication of readings that were published more than once.

A publisher that is run again sends every record again; by default both copies are kept and both
weigh averages. Two ways to keep one: on the landing stream, which remembers what came within some
time, and in batch over what has landed, however far apart the copies came. A repeat is a row equal
in every column it was published with, so a changed reading of the same time and server is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: When a row of a stream was taken in; the time that repeats are remembered by.
_TAKEN = "_taken_at"


def _content(columns: list[str], arrival: tuple[str, ...]) -> list[str]:
    return [name for name in columns if name not in arrival]


def drop_repeats(readings: DataFrame, arrival: tuple[str, ...] = ()) -> DataFrame:
    """One row for each different content, nulls equal to nulls.

    ``arrival`` names columns that tell when or how a row came; of equal rows the one with the
    least of these stays. Copies are dropped before the shuffle as far as a task sees them, so a
    record published a million times costs one row per task.
    """
    content = _content(readings.columns, arrival)
    if not arrival:
        return readings.select(*content).distinct()
    kept = readings.groupBy(*content).agg(F.min(F.struct(*arrival)).alias("_arrival"))
    return kept.select(*content, "_arrival.*").select(*readings.columns)


def drop_stream_repeats(
    readings: DataFrame, within: str, arrival: tuple[str, ...] = ()
) -> DataFrame:
    """A stream without the copies of rows taken in up to ``within`` earlier.

    The time is that of the batch that reads a row, never the row's own, so no row can be too late
    and get lost, whatever order a backlog is read in. The state holds one key per different row
    of the last ``within``; a copy that comes later than that is kept (see :func:`drop_repeats`).
    A batch that is repeated after a failure sees its own time again.
    """
    content = _content(readings.columns, arrival)
    taken = readings.withColumn(_TAKEN, F.current_timestamp()).withWatermark(_TAKEN, within)
    return taken.dropDuplicatesWithinWatermark(content).drop(_TAKEN)
