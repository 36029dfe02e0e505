"""Alerts over a landing that grows: each day of arrival is aggregated once and kept.

A *partial table* holds, per (day of arrival, server, time), the row counts and partial aggregates
of both sides of a rule, partitioned by that day. Partials merge by sums and maxima, so the table
of all days gives what the readings of all days give, whichever day brought which side of a key.
A later run reads the landing's file list, aggregates only the days whose files have changed, and
replaces their partitions. A day holds at most one row per server and time, however many readings
it brought.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvigil.config import AlertRule
from hostvigil.operators.matching import group_readings, match_groups, merge_groups, partial_names
from hostvigil.operators.split import readings_of
from hostvigil.operators.windows import keep_reachable
from hostvigil.plans.alerts import format_alerts, label_windows, window_matched
from hostvigil.schemas import LANDED, METRICS
from hostvigil.sources.landed import file_lists

DAY = "ingest_date"


def partial_schema(rule: AlertRule) -> str:
    """The columns of a rule's partial table."""
    kinds = {"rows": "long", "n": "long"}
    columns = [f"server_id string, ts string, {DAY} date, source string"]
    for side, name in ((rule.left, "left"), (rule.right, "right")):
        value = METRICS[side.metric].simpleString() if rule.aggregate == "max" else "double"
        columns += [f"{x} {kinds.get(x.removeprefix(f'{name}_'), value)}"
                    for x in partial_names(name, rule.aggregate)]
    return ", ".join(columns)


def read_partials(spark: SparkSession, path: str, rule: AlertRule) -> DataFrame:
    """The partial table under ``path``."""
    return spark.read.schema(partial_schema(rule)).parquet(path)


def changed_days(
    spark: SparkSession, landing: str, partials: str, rule: AlertRule
) -> list[tuple[date, str]]:
    """Days of arrival whose files are not those that the partial table was made of.

    Returned to the driver with their file lists' digests: one short row per such day.
    """
    lists = file_lists(spark, landing, (rule.left.topic, rule.right.topic), by=(DAY,))
    known = _known(spark, partials, rule)
    if known is not None:
        lists = lists.join(known, [DAY, "source"], "left_anti")
    return sorted((row[DAY], row.source) for row in lists.select(DAY, "source").collect())


def _known(spark: SparkSession, partials: str, rule: AlertRule) -> DataFrame | None:
    """(day, source) of what was aggregated; None before the first run."""
    try:
        # Every row of a day has the same digest, so this reads one dictionary-coded column.
        return read_partials(spark, partials, rule).select(DAY, "source").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def day_partials(landed: DataFrame, rule: AlertRule) -> DataFrame:
    """Partials of landed rows, by day of arrival."""
    left, right = (
        readings_of(landed, side.topic, keep=(DAY,)) for side in (rule.left, rule.right)
    )
    return group_readings(left, right, rule, by=(DAY,))


def add_new_days(spark: SparkSession, landing: str, partials: str, rule: AlertRule) -> list[date]:
    """Aggregate the days of a landing that are new or have grown; returns them.

    A day's partition is replaced whole, so a run that failed is simply repeated. The file list
    is taken before the files are read: what is landed in between makes the day differ again next
    time. Days that the landing no longer has stay in the partial table.
    """
    days = changed_days(spark, landing, partials, rule)
    if not days:
        return []
    landed = spark.read.schema(LANDED).parquet(landing)
    wanted = landed.filter(F.col(DAY).isin([day for day, _ in days]))
    source = F.create_map(*(F.lit(x) for pair in days for x in pair))[F.col(DAY)]
    added = day_partials(wanted, rule).withColumn("source", source)
    added.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        DAY
    ).parquet(partials)
    return [day for day, _ in days]


def partial_windows(partials: DataFrame, rule: AlertRule) -> DataFrame:
    """Labelled windows of everything that was aggregated."""
    grouped = merge_groups(keep_reachable(partials, rule), rule)
    return label_windows(window_matched(match_groups(grouped), rule), rule)


def partial_alerts(partials: DataFrame, rule: AlertRule, ordered: bool = False) -> DataFrame:
    """The alert table of everything that was aggregated."""
    return format_alerts(partial_windows(partials, rule), rule, ordered)
