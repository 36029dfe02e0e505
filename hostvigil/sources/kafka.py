"""Kafka topics, in batch and as a stream. Needs the Kafka connector on the class path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from hostvigil.schemas import TOPICS

COLUMNS = ("topic", "value", "timestamp")


def kafka_options(
    servers: str, topics: Iterable[str] = tuple(TOPICS), min_partitions: int | None = None
) -> dict[str, str]:
    """Options of a read from the earliest offsets of the given topics."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if min_partitions:
        # Splits long topic partitions into several read tasks.
        options["minPartitions"] = str(min_partitions)
    return options


def read_topics(spark: SparkSession, servers: str, **kwargs) -> DataFrame:
    """All messages up to now, as (topic, value, timestamp)."""
    options = kafka_options(servers, **kwargs) | {"endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load().select(*COLUMNS)


def stream_topics(
    spark: SparkSession, servers: str, per_batch: int = 50_000_000, **kwargs
) -> DataFrame:
    """Messages as they come, as (topic, value, timestamp); positions are kept in the checkpoint.

    A batch reads at most ``per_batch`` messages, so a long backlog is drained in steps and a
    failure repeats one of them.
    """
    options = kafka_options(servers, **kwargs) | {"maxOffsetsPerTrigger": str(per_batch)}
    return spark.readStream.format("kafka").options(**options).load().select(*COLUMNS)
