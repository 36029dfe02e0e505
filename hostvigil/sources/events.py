"""Host readings derived from a table of user events (ts, user_id, value, props)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.functions import clock_of

# Fixed values of the derivation.
SERVERS = 20


def wide_from_events(
    events: DataFrame, full_timestamp: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Wide readings, timed by time-of-day text or by real timestamps to the second.

    ``keep`` names columns of ``events`` to carry along.
    """
    k = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    ts = F.date_trunc("second", "ts") if full_timestamp else clock_of(F.col("ts"))
    return events.select(
        *keep,
        ts.alias("ts"),
        F.concat(F.lit("server_"), (F.col("user_id") % SERVERS).cast("string")).alias("server_id"),
        F.least(value, F.lit(100.0)).alias("cpu_pct"),
        k.alias("mem_pct"),
        (value * 100).alias("net_in"),
        (value * 10).alias("net_out"),
        (k * 16).alias("disk_io"),
    )
