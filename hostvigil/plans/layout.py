"""A bucketed layout of partial tables, from which alerts are computed without a shuffle.

A day's partials are dealt once, when the day arrives, to buckets by (server, block of the day), and
those whose windows start in the block before are stored there as well. Every key of every day
then lies in the bucket that all windows of its block lie in, so merging the days, matching both
sides and forming windows are steps within one task. A bucket never holds more than one row per
server, second and day, whatever the readings: a server with a third of all readings is as large as
any other here, and its day is spread over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvigil.config import AlertRule
from hostvigil.functions import second_of_day
from hostvigil.operators.matching import match_groups, merge_groups, weigh
from hostvigil.operators.windows import (
    block_seconds,
    blocks_of,
    keep_reachable,
    windows_in_blocks,
)
from hostvigil.plans.alerts import format_alerts, label_windows
from hostvigil.plans.incremental import DAY, partial_schema
from hostvigil.sinks.tables import make_folder

_KEYS = ("server_id", "block")
_LENGTH = "block_seconds"


def open_layout(
    spark: SparkSession, name: str, path: str, rule: AlertRule, buckets: int
) -> DataFrame:
    """The layout under ``path`` as the table ``name`` of this session's catalogue, made if it is
    missing. ``buckets`` is how many tasks read it; it is fixed once the layout is made."""
    make_folder(spark, path)  # partitions can be looked for in one that is there only
    columns = [c for c in partial_schema(rule).split(", ") if c.split()[0] not in (DAY, "source")]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}, block bigint, {DAY} date) "
        f"USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({DAY}) "
        f"CLUSTERED BY ({', '.join(_KEYS)}) INTO {buckets} BUCKETS LOCATION '{path}' "
        f"TBLPROPERTIES ('{_LENGTH}' = '{block_seconds(rule)}')"
    )
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def _buckets(spark: SparkSession, name: str) -> int:
    found = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    return int(found.data_type)


def lay_out(partials: DataFrame, name: str, rule: AlertRule, days: Iterable[date]) -> None:
    """Put some days of a partial table into the layout, replacing what it has of them.

    Times that cannot be read have no block and are left out; they are in no window.
    """
    days = list(days)
    if not days:
        return
    spark = partials.sparkSession
    second = second_of_day(F.col("ts"))
    placed = (
        partials.filter(F.col(DAY).isin(days))
        .filter(second.isNotNull())
        .withColumn("block", F.explode(blocks_of(second, rule)))
        # By the buckets' own hash, so a task writes one file a day.
        .repartition(_buckets(spark, name), *_KEYS)
    )
    placed.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)


def layout_windows(spark: SparkSession, name: str, rule: AlertRule) -> DataFrame:
    """Labelled windows of all days in a layout; no shuffle."""
    length = spark.sql(f"SHOW TBLPROPERTIES {name} ('{_LENGTH}')").first().value
    if length != str(block_seconds(rule)):
        raise ValueError(f"{name} has blocks of {length} s, the rule needs {block_seconds(rule)}")
    rows = keep_reachable(spark.table(name), rule)
    matched = match_groups(merge_groups(rows, rule, by=("block",)))
    second = second_of_day(F.col("ts"))
    weighed = weigh(matched, rule, *map(F.col, _KEYS), second.alias("second"))
    return label_windows(windows_in_blocks(weighed, rule), rule)


def layout_alerts(
    spark: SparkSession, name: str, rule: AlertRule, ordered: bool = False
) -> DataFrame:
    """The alert table of all days in a layout."""
    return format_alerts(layout_windows(spark, name, rule), rule, ordered)
