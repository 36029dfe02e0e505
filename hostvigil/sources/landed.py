"""Landed per-metric tables and written alerts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hostvigil.operators.repeats import drop_repeats
from hostvigil.operators.split import readings_of
from hostvigil.schemas import LANDED


def read_landed(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", strict: bool = False
) -> DataFrame:
    """A table of one topic, with its schema given rather than inferred.

    CSV columns bind by position whatever the header says, unless ``strict``.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", not strict)
    return reader.format(fmt).load(path)


def file_lists(
    spark: SparkSession, landing: str, topics: Iterable[str], by: tuple[str, ...]
) -> DataFrame:
    """Which files the landing has for some topics, as (*by, files, bytes, source).

    ``by`` names partition columns. ``source`` is a digest of a partition's list of files, which
    differs once files are added or taken away. Only files whose batch was committed are listed.
    """
    # No file is opened: neither the content nor anything that needs it is asked for.
    files = spark.read.format("binaryFile").load(landing)
    name = F.element_at(F.split("path", "/"), -1)
    return (
        files.filter(F.col("topic").isin(*topics))
        .select(*(F.col(c).cast(LANDED[c].dataType).alias(c) for c in by), name.alias("name"),
                "length")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
             # Names are unique, so sums of hashes tell lists apart that sizes do not.
             F.sum(F.xxhash64("name").cast("decimal(38,0)")).alias("names"))
        .select(*by, "files", "bytes", F.concat_ws("/", "files", "bytes", "names").alias("source"))
    )


def read_landed_topic(
    spark: SparkSession, path: str, topic: str, since: str | None = None,
    until: str | None = None, distinct: bool = False, compacted: str | None = None,
) -> DataFrame:
    """One topic of a table written by the streaming landing; no rows if nothing has landed.

    ``since`` and ``until`` are the first and last day of arrival to read (``yyyy-MM-dd``).
    ``distinct`` leaves out copies of readings that were published again. ``compacted`` names the
    compacted table of the landing; days of the topic that are there as they are in the landing
    are read from it.
    """
    landed = spark.read.schema(LANDED).parquet(path)
    if compacted is not None:
        days = _compacted_days(spark, path, compacted, topic)
        whole = spark.read.schema(LANDED).parquet(compacted)
        there = F.col("ingest_date").isin(days)
        landed = landed.filter(~there).unionByName(whole.filter(there))
    if since is not None:
        landed = landed.filter(F.col("ingest_date") >= F.lit(date.fromisoformat(since)))
    if until is not None:
        landed = landed.filter(F.col("ingest_date") <= F.lit(date.fromisoformat(until)))
    readings = readings_of(landed, topic)
    return drop_repeats(readings) if distinct else readings


def _compacted_days(spark: SparkSession, landing: str, compacted: str, topic: str) -> list[date]:
    """The days of a topic whose compacted rows are those of the files it has now."""
    now = file_lists(spark, landing, (topic,), by=("ingest_date", "topic"))
    schema = "ingest_date date, topic string, source string"
    known = spark.read.schema(schema).parquet(compacted).filter(F.col("topic") == topic).distinct()
    same = now.join(known, ["ingest_date", "topic", "source"], "left_semi")
    return sorted(row.ingest_date for row in same.select("ingest_date").collect())


def read_alerts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An alert table written as CSV, in which windows without an alert hold an empty text."""
    # The reader's default takes quoted empty text for null.
    return spark.read.csv(path, schema=schema, header=True, nullValue="\0")
