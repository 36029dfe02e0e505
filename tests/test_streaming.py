"""Streams over files in place of Kafka."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hostvigil.config import CPU_MEM, NET_DISK
from hostvigil.operators.split import split_topic, to_records
from hostvigil.plans.alerts import alerts
from hostvigil.schemas import TOPICS, WIDE
from hostvigil.sources.landed import read_landed_topic
from hostvigil.streaming.continuous import continuous_alerts, start_alerts
from hostvigil.streaming.landing import MessageCounter, start_landing

START = datetime(2024, 1, 1, 20, 53)


def wide_rows(n, first=0):
    return [
        (f"20:53:{i:02d}", f"s{i % 2}", float(i), i / 2, i * 1.5, 0.0, None)
        for i in range(first, first + n)
    ]


def test_landing_equals_the_batch_split_and_lands_once(spark, tmp_path):
    inbox, table, check = (str(tmp_path / name) for name in ("inbox", "table", "check"))
    wide = spark.createDataFrame(wide_rows(10), WIDE)
    to_records(wide).write.parquet(inbox)
    bad = spark.createDataFrame([("topic-cpu", bytearray(b"{oops"))], "topic string, value binary")
    bad.write.mode("append").parquet(inbox)

    def drain():
        stream = spark.readStream.schema("topic string, value binary").parquet(inbox)
        counter = MessageCounter()
        spark.streams.addListener(counter)
        try:
            return counter.wait(start_landing(stream, table, check))
        finally:
            spark.streams.removeListener(counter)

    assert drain() == 41
    for topic in TOPICS:
        got = read_landed_topic(spark, table, topic)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(
            map(tuple, split_topic(wide, topic).collect()), key=repr
        )
    refused = spark.read.parquet(table).filter("problem is not null").collect()
    assert [(r.topic, r.problem, r.raw) for r in refused] == [("topic-cpu", "undecodable", "{oops")]

    more = spark.createDataFrame(wide_rows(5, first=10), WIDE)
    to_records(more).write.mode("append").parquet(inbox)
    assert drain() == 20  # only what is new
    assert drain() == 0
    assert read_landed_topic(spark, table, "topic-mem").count() == 15

    plan = read_landed_topic(spark, table, "topic-net")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(topic" in plan.toString()
    assert "cpu_pct" not in plan.toString().split("ReadSchema")[1]


def stamped_rows(offsets, server="s"):
    return [
        (START + timedelta(seconds=s), server, float(s % 97), 80.0, 100.0 * s, 0.0, 1300.0)
        for s in offsets
    ]


STAMPED = "ts timestamp, server_id string, cpu_pct double, mem_pct double, " \
          "net_in double, net_out double, disk_io double"


@pytest.mark.parametrize("rule", [CPU_MEM, NET_DISK], ids=lambda rule: rule.name)
def test_continuous_alerts_equal_batch_once_closed(spark, tmp_path, rule):
    inbox, out, check = (str(tmp_path / name) for name in ("inbox", "out", "check"))
    first = stamped_rows([*range(0, 60, 5), 10, 10])  # one key three times: 9 joined rows
    second = stamped_rows(range(60, 120, 5))
    late = stamped_rows([1], "late")
    closing = stamped_rows([7200], "closing")

    def arrive(rows):
        spark.createDataFrame(rows, STAMPED).coalesce(1).write.mode("append").parquet(inbox)
        sides = [
            split_topic(spark.readStream.schema(STAMPED).parquet(inbox), side.topic)
            for side in (rule.left, rule.right)
        ]
        query = start_alerts(continuous_alerts(*sides, rule), out, check, available_now=True)
        query.awaitTermination()
        return spark.read.parquet(out)

    early = arrive(first)
    assert {r.window_start for r in early.collect()} <= {"20:53:00"}
    arrive(second)
    arrive(late)  # its windows have closed
    got = arrive(closing)
    wide = spark.createDataFrame(first + second, STAMPED)
    want = alerts(split_topic(wide, rule.left.topic), split_topic(wide, rule.right.topic), rule)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 10


def test_a_landing_is_read_by_days_of_arrival(spark, tmp_path):
    inbox, table, check = (str(tmp_path / name) for name in ("inbox", "table", "check"))
    wide = spark.createDataFrame(wide_rows(4), WIDE)
    records = to_records(wide)
    for day in (1, 2, 3):
        stamp = F.lit(datetime(2024, 5, day, 12)).alias("timestamp")
        records.select("*", stamp).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(spark.read.parquet(inbox).schema).parquet(inbox)
    start_landing(stream, table, check).awaitTermination()
    count = lambda *days: read_landed_topic(spark, table, "topic-cpu", *days).count()
    assert [count(), count("2024-05-02"), count("2024-05-02", "2024-05-02")] == [12, 8, 4]
    assert count(None, "2024-04-30") == 0
    ranged = read_landed_topic(spark, table, "topic-cpu", "2024-05-02", "2024-05-02")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "topic" in filters and "ingest_date" in filters


def test_streams_take_timestamps_without_a_zone(spark, tmp_path):
    inbox, out, check = (str(tmp_path / name) for name in ("inbox", "out", "check"))
    schema = STAMPED.replace("ts timestamp", "ts timestamp_ntz")
    rows = stamped_rows([0, 5, 7200])
    spark.createDataFrame(rows, schema).write.parquet(inbox)
    sides = [
        split_topic(spark.readStream.schema(schema).parquet(inbox), side.topic)
        for side in (CPU_MEM.left, CPU_MEM.right)
    ]
    query = start_alerts(continuous_alerts(*sides, CPU_MEM), out, check, available_now=True)
    query.awaitTermination()
    assert [r.window_start for r in spark.read.parquet(out).collect()] == ["20:53:00"]


def test_mixed_times_are_refused(spark):
    clock = spark.createDataFrame(wide_rows(1), WIDE)
    stamped = spark.createDataFrame(stamped_rows([0]), STAMPED)
    with pytest.raises(ValueError, match="times of day and the other timestamps"):
        alerts(split_topic(clock, "topic-cpu"), split_topic(stamped, "topic-mem"), CPU_MEM)


def test_time_of_day_text_is_refused(spark):
    df = spark.createDataFrame(wide_rows(1), WIDE)
    with pytest.raises(ValueError, match="real timestamps"):
        continuous_alerts(split_topic(df, "topic-cpu"), split_topic(df, "topic-mem"), CPU_MEM)


def test_timestamps_keep_days_apart(spark):
    rows = stamped_rows([0]) + [(START + timedelta(days=1), "s", 50.0, 80.0, 0.0, 0.0, 0.0)]
    wide = spark.createDataFrame(rows, STAMPED)
    got = alerts(split_topic(wide, "topic-cpu"), split_topic(wide, "topic-mem"), CPU_MEM)
    assert sorted(r.avg_cpu for r in got.filter("window_start = '20:53:00'").collect()) == [0, 50]
    clock = wide.withColumn("ts", F.date_format("ts", "HH:mm:ss"))
    folded = alerts(split_topic(clock, "topic-cpu"), split_topic(clock, "topic-mem"), CPU_MEM)
    assert [r.avg_cpu for r in folded.filter("window_start = '20:53:00'").collect()] == [25.0]
