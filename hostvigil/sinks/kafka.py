"""Publishing topic records. Needs the Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_topics(records: DataFrame, servers: str) -> None:
    """Send (topic, value) records without keys; returns when all are acknowledged."""
    records.select("topic", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).save()
