"""The inner join of two metrics on (time, server).

``match_readings`` is what the alert plans use. A key seen m times on the left and n times on
the right joins into m * n rows, but every later step only needs each side's aggregate weighted
by the other side's row count. So both sides are aggregated per key in one shuffle, with partial
aggregation before it, and no pair is ever built: a key holding a third of all rows costs one
row per task that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.config import AlertRule, Side

# Per side and aggregate: the columns that carry an aggregate from keys to windows.
PARTIALS = {"avg": ("sum", "n"), "max": ("max",)}


def partial_names(name: str, aggregate: str) -> list[str]:
    """What a group of readings holds of one side: its row count and partial aggregates."""
    return [f"{name}_{part}" for part in ("rows", *PARTIALS[aggregate])]


def _one_side(
    readings: DataFrame, side: Side, is_left: bool, by: tuple[str, ...] = ()
) -> DataFrame:
    value = F.col(side.metric).cast(side.metric_type)
    counted = F.lit(is_left)
    if "is_beat" in readings.columns:  # heartbeats of a stream count for neither side
        counted = F.when(~F.col("is_beat"), counted)
    absent = F.lit(None).cast(side.metric_type)
    return readings.select(
        *by,
        "server_id",
        "ts",
        counted.alias("is_left"),
        (value if is_left else absent).alias("left_value"),
        (absent if is_left else value).alias("right_value"),
    )


def _key_partials(name: str, aggregate: str) -> list[Column]:
    value = F.col(f"{name}_value")
    if aggregate == "max":
        return [F.max(value).alias(f"{name}_max")]
    return [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]


def group_readings(
    left: DataFrame, right: DataFrame, rule: AlertRule, by: tuple[str, ...] = ()
) -> DataFrame:
    """One row per (server, time) on either side: row counts and aggregates of both sides.

    ``by`` names further columns of both sides to group by.
    """
    both = _one_side(left, rule.left, True, by).unionByName(
        _one_side(right, rule.right, False, by)
    )
    return both.groupBy(*by, "server_id", "ts").agg(
        F.count_if(F.col("is_left")).alias("left_rows"),
        F.count_if(~F.col("is_left")).alias("right_rows"),
        *_key_partials("left", rule.aggregate),
        *_key_partials("right", rule.aggregate),
    )


def merge_groups(grouped: DataFrame, rule: AlertRule, by: tuple[str, ...] = ()) -> DataFrame:
    """Groups of readings that may share (server, time), merged to one row each.

    ``by`` names further columns to group by.
    """
    merge = F.sum if rule.aggregate == "avg" else F.max
    return grouped.groupBy("server_id", *by, "ts").agg(
        *(
            (F.sum if name.endswith("_rows") else merge)(name).alias(name)
            for side in ("left", "right")
            for name in partial_names(side, rule.aggregate)
        )
    )


def match_readings(left: DataFrame, right: DataFrame, rule: AlertRule) -> DataFrame:
    """The joined keys, each standing for ``left_rows * right_rows`` joined rows."""
    return match_groups(group_readings(left, right, rule))


def match_groups(grouped: DataFrame) -> DataFrame:
    """The keys that both sides have."""
    # Both conditions on the keys are pushed below the aggregate, down to the scans.
    return grouped.filter(F.col("ts").isNotNull() & F.col("server_id").isNotNull()).filter(
        (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    )


def joined_rows() -> Column:
    """How many joined rows a matched key stands for; exact beyond the range of a long."""
    return F.col("left_rows").cast("decimal(19,0)") * F.col("right_rows").cast("decimal(19,0)")


def weigh(matched: DataFrame, rule: AlertRule, *keys: Column) -> DataFrame:
    """The given keys plus each side's partial aggregate over the joined rows of its key."""
    columns = []
    for name, other in (("left", "right"), ("right", "left")):
        for part in PARTIALS[rule.aggregate]:
            value = F.col(f"{name}_{part}").cast("double")
            if rule.aggregate == "avg":
                value = value * F.col(f"{other}_rows").cast("double")
            columns.append(value.alias(f"{name}_{part}"))
    return matched.select(*keys, *columns)


def merge_partials(rule: AlertRule) -> list[Column]:
    """Aggregates that merge weighted partials into larger groups."""
    merge = F.sum if rule.aggregate == "avg" else F.max
    return [
        merge(f"{name}_{part}").alias(f"{name}_{part}")
        for name in ("left", "right")
        for part in PARTIALS[rule.aggregate]
    ]


def merged_value(name: str, rule: AlertRule) -> Column:
    """The finished aggregate of one side; null where no reading had a value."""
    if rule.aggregate == "max":
        return F.col(f"{name}_max")
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))
