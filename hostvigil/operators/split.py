"""Vertical split of wide readings into per-metric tables and topic records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.functions import (
    encode_record,
    finite_number,
    may_hold_more,
    one_value,
    parse_value,
)
from hostvigil.schemas import METRICS, TOPICS


def split_topic(wide: DataFrame, topic: str) -> DataFrame:
    """The narrow table of one topic, in the column types it is analysed in."""
    metrics = TOPICS[topic].fields[2:]
    return wide.select("ts", "server_id", *(F.col(f.name).cast(f.dataType) for f in metrics))


def to_records(wide: DataFrame) -> DataFrame:
    """All topics' records as (topic, value), from one pass over the wide table."""
    records = F.array(
        *(
            F.struct(F.lit(topic).alias("topic"), encode_record(*schema.names).alias("value"))
            for topic, schema in TOPICS.items()
        )
    )
    return wide.select(F.inline(records))


def from_records(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode (topic, value): text keys, numeric metrics, and why a record was refused.

    Records that are no JSON object keep their bytes in ``raw`` and name a ``problem``; later
    records are unaffected. Absent and non-finite metrics are null. ``keep`` names columns to
    carry along.
    """
    texts = records.select(
        *keep, "topic", F.btrim(F.col("value").cast("string"), F.lit(" \t\n\r")).alias("text")
    )
    # Only an object is a record, though the parser takes lists of them as well. More can only
    # follow a closing brace, and records as published end with their only one, so hardly any text
    # is parsed a second time.
    text = F.col("text")
    alone = F.when(may_hold_more(text), one_value(text)).otherwise(True)
    parsed = texts.withColumns(
        {"parsed": parse_value(text), "is_object": text.startswith("{") & alone}
    )
    is_record = F.col("is_object") & F.col("parsed._corrupt").isNull()
    decoded = parsed.withColumn("refused", ~F.coalesce(is_record, F.lit(False)))
    refused = F.col("refused")
    return decoded.select(
        *keep,
        "topic",
        *(F.when(~refused, F.col(f"parsed.record.{key}")).alias(key) for key in ("ts", "server_id")),
        *(
            F.when(~refused, finite_number(F.col(f"parsed.record.{name}"), kind.simpleString())).alias(
                name
            )
            for name, kind in METRICS.items()
        ),
        F.when(refused, "undecodable").alias("problem"),
        F.when(refused, F.col("text")).alias("raw"),
    )


def readings_of(decoded: DataFrame, topic: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One topic's readings from decoded or landed records; ``keep`` names columns to carry along."""
    accepted = (F.col("topic") == topic) & F.col("problem").isNull()
    return decoded.filter(accepted).select(*keep, *TOPICS[topic].names)
