"""Explicit schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _F, _D = T.StringType(), T.FloatType(), T.DoubleType()

# Column names, order and widths of the tables.
WIDE = _table(ts=_S, server_id=_S, cpu_pct=_D, mem_pct=_D, net_in=_D, net_out=_D, disk_io=_D)
CPU = _table(ts=_S, server_id=_S, cpu_pct=_F)
MEM = _table(ts=_S, server_id=_S, mem_pct=_F)
NET = _table(ts=_S, server_id=_S, net_in=_D, net_out=_D)
DISK = _table(ts=_S, server_id=_S, disk_io=_D)

# Topic name -> schema of the readings it carries.
TOPICS = {"topic-cpu": CPU, "topic-mem": MEM, "topic-net": NET, "topic-disk": DISK}

# Every metric column any topic may carry, in the width it is analysed in.
METRICS = {
    field.name: field.dataType
    for schema in TOPICS.values()
    for field in schema.fields[2:]
}

CPU_MEM_ALERT = _table(
    server_id=_S, window_start=_S, window_end=_S, avg_cpu=_D, avg_mem=_D, alert=_S
)
NET_DISK_ALERT = _table(
    server_id=_S, window_start=_S, window_end=_S, max_net_in=_D, max_disk_io=_D, alert=_S
)

# What the landing writes, refused records included; partitioned by day of arrival and topic.
LANDED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("topic", "ts", "server_id")]
    + [T.StructField(name, kind) for name, kind in METRICS.items()]
    + [T.StructField(name, T.StringType()) for name in ("problem", "raw")]
    + [T.StructField("ingest_date", T.DateType())]
)
