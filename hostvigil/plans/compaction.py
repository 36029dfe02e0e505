"""Compaction: days of a landing rewritten into few files sorted by server and time.

A landing adds a file per task, topic and batch. Its files belong to the streaming query that
writes them, whose log names each one, so they are left alone: a second table holds whole days of
topics in large sorted files, and readers take a day from there as long as it was made of the
files that the landing has now (``read_landed_topic(..., compacted=...)``). A landing may go on
meanwhile; a day that it adds to is read from it again until the next compaction.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvigil.schemas import LANDED, TOPICS
from hostvigil.sources.landed import file_lists

_BY = ("ingest_date", "topic")
_SCHEMA = "ingest_date date, topic string, source string"


def _changed(spark: SparkSession, landing: str, compacted: str, topics: Iterable[str]) -> DataFrame:
    lists = file_lists(spark, landing, topics, by=_BY)
    try:
        known = spark.read.schema(_SCHEMA).parquet(compacted).distinct()
    except AnalysisException as error:  # nothing was compacted yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return lists
    return lists.join(known, [*_BY, "source"], "left_anti")


def compact_days(
    spark: SparkSession,
    landing: str,
    compacted: str,
    before: str | None = None,
    topics: Iterable[str] = tuple(TOPICS),
    file_bytes: int = 256 << 20,
    file_rows: int = 2_000_000,
) -> list[tuple[date, str]]:
    """Compact all days of arrival before a day (``yyyy-MM-dd``, else today) that have changed;
    returns (day, topic) of what was rewritten.

    Rows are dealt by ranges of (day, topic, server, time), so a day of a busy server is spread over
    files as well, and a file's row groups hold few servers each. A file has about ``file_rows`` rows
    at most, however well they were compressed, as the task that writes it sorts them. Partitions
    are replaced whole: a run that fails is repeated.
    """
    last = F.current_date() if before is None else F.lit(date.fromisoformat(before))
    changed = _changed(spark, landing, compacted, topics).filter(F.col("ingest_date") < last)
    rows = changed.select(*_BY, "bytes", "source").collect()  # a short row per day and topic
    if not rows:
        return []
    name = lambda row: f"{row.ingest_date}/{row.topic}"
    sources = F.create_map(*(F.lit(x) for row in rows for x in (name(row), row.source)))
    landed = spark.read.schema(LANDED).parquet(landing).filter(
        F.col("ingest_date").isin(sorted({row.ingest_date for row in rows}))
        & F.col("topic").isin(sorted({row.topic for row in rows}))
    )
    marked = landed.withColumn("source", sources[F.concat_ws("/", *_BY)])
    order = [*_BY, "server_id", "ts"]
    marked = marked.filter(F.col("source").isNotNull())
    # The files' footers hold their numbers of rows.
    files = max(-(-sum(row.bytes for row in rows) // file_bytes), -(-marked.count() // file_rows))
    (
        marked.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_BY)
        .parquet(compacted)
    )
    return sorted((row.ingest_date, row.topic) for row in rows)
