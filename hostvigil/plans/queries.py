"""The registered queries: every operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hostvigil.config import CPU_MEM, NET_DISK, AlertRule
from hostvigil.functions import clock_of, encode_record, time_of_day
from hostvigil.jobs.alerting import main as run_from_command_line
from hostvigil.jobs.alerting import run_alert_job
from hostvigil.operators.counts import count_by_topic, pair_summary
from hostvigil.operators.matching import joined_rows, match_readings, merged_value, weigh
from hostvigil.operators.preview import first_rows
from hostvigil.operators.quarantine import count_problems, mark_bad_times, quarantined, usable
from hostvigil.operators.split import from_records, split_topic, to_records
from hostvigil.plans.alerts import alerts, format_alerts, metric_windows
from hostvigil.plans.compaction import compact_days
from hostvigil.plans.incremental import add_new_days, partial_alerts, read_partials
from hostvigil.plans.layout import lay_out, layout_alerts, open_layout
from hostvigil.schemas import CPU_MEM_ALERT, NET_DISK_ALERT, TOPICS, WIDE
from hostvigil.session import scratch_dir
from hostvigil.sinks.tables import drop_table, publish_single_csv, replace_table, write_table
from hostvigil.sources.events import wide_from_events
from hostvigil.sources.landed import read_alerts, read_landed, read_landed_topic
from hostvigil.sources.wide_csv import read_wide_csv
from hostvigil.streaming.continuous import continuous_alerts, start_alerts
from hostvigil.streaming.heartbeat import drain_and_close, open_beats
from hostvigil.streaming.landing import MessageCounter, start_landing
from hostvigil.streaming.late import (
    add_corrections,
    corrected_windows,
    latest_windows,
    read_late,
    read_windows,
    windows_and_late,
)

Query = Callable[[SparkSession, str], DataFrame]


# Thresholds of the jobs run from their command lines; the flag is that of the second input.
FILE_THRESHOLDS = {
    "cpu_threshold": 60.5, "mem_threshold": 1, "net_in_threshold": 5000.25, "disk_io_threshold": 1,
}
FLAG_THRESHOLD = 45.0


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _events(spark, sf_dir).schema
    # A pattern, because a file stream takes a single file only as the match of one.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_from_events(_events(spark, sf_dir))


def _pair(wide: DataFrame, rule: AlertRule) -> tuple[DataFrame, DataFrame]:
    return split_topic(wide, rule.left.topic), split_topic(wide, rule.right.topic)


# Sources and splits


def wide_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings, written as wide CSV files with headers and scanned line by line."""
    folder = scratch_dir(spark, "wide-csv")
    write_table(_wide(spark, sf_dir), folder, "csv")
    return usable(read_wide_csv(spark, folder))


def wide_csv_skip_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings in a few CSV files, by event, without the first record of each file."""
    folder = scratch_dir(spark, "first-records")
    readings = wide_from_events(_events(spark, sf_dir), keep=("event_id",))
    part = F.pmod(F.col("event_id"), F.lit(5)).alias("part")
    by_file = readings.select("*", part).repartition("part").sortWithinPartitions("part", "event_id")
    by_file.select("part", *WIDE.names).write.partitionBy("part").csv(folder, header=True)
    return usable(read_wide_csv(spark, folder, skip_first_record=True))


def split_query(topic: str) -> Query:
    """The narrow table of one topic."""
    return lambda spark, sf_dir: split_topic(_wide(spark, sf_dir), topic)


def _by_metric(decoded: DataFrame) -> DataFrame:
    """Decoded records as one row per metric that their topic carries."""
    metrics = F.array(
        *(
            F.struct(
                F.lit(topic).alias("of"),
                F.lit(name).alias("metric"),
                F.col(name).cast("double").alias("value"),
            )
            for topic, schema in TOPICS.items()
            for name in schema.names[2:]
            if name in decoded.columns
        )
    )
    carried = F.filter(metrics, lambda metric: metric["of"] == F.col("topic"))
    return decoded.select("topic", "ts", "server_id", F.inline(carried)).drop("of")


def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings encoded as topic records, decoded, one row per metric."""
    return _by_metric(from_records(to_records(_wide(spark, sf_dir))))


def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per topic."""
    return count_by_topic(to_records(_wide(spark, sf_dir)))


def parse_time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad spellings of every event's time, and what is read from them."""
    ts = F.col("ts")
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 0, F.date_format(ts, "H:mm:ss"))
        .when(kind == 1, F.date_format(ts, "HH:mm"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 3, F.concat(F.lit("24:"), F.date_format(ts, "mm:ss")))
        .when(kind == 4, F.lit(""))
        .otherwise(clock_of(ts))
    )
    spelled = _events(spark, sf_dir).select("event_id", text.alias("text"))
    return spelled.select("event_id", "text", clock_of(time_of_day(F.col("text"))).alias("parsed"))


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a CSV line and as a record, many damaged: what each stage refuses."""
    events = _events(spark, sf_dir)
    numbered = wide_from_events(events, keep=("event_id",))
    damage = F.col("event_id") % 10
    line = F.concat_ws(",", *(F.col(name).cast("string") for name in WIDE.names))
    damaged_line = (
        F.when(damage == 0, F.concat(line, F.lit(",1")))
        .when(damage == 1, F.regexp_replace(line, ",[^,]*$", ""))
        .when(damage == 2, F.regexp_replace(line, ",[^,]*$", ",abc"))
        .when(damage == 3, F.concat(F.lit("x"), line))
        .when(damage == 4, F.lit("ts,server_id,cpu_pct"))
        .when(damage == 5, F.lit("  "))
        .otherwise(line)
    )
    folder = scratch_dir(spark, "damaged-csv")
    numbered.select(damaged_line.alias("value")).write.text(folder)
    checked = read_wide_csv(spark, folder)
    times = mark_bad_times(usable(checked))
    value = encode_record(*TOPICS["topic-cpu"].names).cast("string")
    damaged_value = (
        F.when(damage == 0, F.expr("left(v, length(v) - 1)"))
        .when(damage == 1, F.lit("[1]"))
        .when(damage == 2, F.lit(""))
        .otherwise(F.col("v"))
    )
    records = from_records(
        numbered.withColumn("v", value).select(
            F.lit("topic-cpu").alias("topic"), damaged_value.cast("binary").alias("value")
        )
    )
    stages = (("line", checked), ("time", times), ("record", records))
    counts = [
        count_problems(rows).select(F.lit(stage).alias("stage"), "problem", "n")
        for stage, rows in stages
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a CSV line, many damaged: the refused lines as they were."""
    events = wide_from_events(_events(spark, sf_dir), keep=("event_id",))
    number = F.col("event_id").cast("string")
    damage = F.col("event_id") % 10

    def line(*fields) -> Column:
        return F.concat_ws(",", "ts", "server_id", number, *(F.lit(field) for field in fields))

    good = line("1e2", "0.10", "+5", "7")
    spelled = (
        F.when(damage == 0, F.concat(good, F.lit(",1")))
        .when(damage == 1, line("1e2"))
        .when(damage == 2, line("1e2", "0.10", "abc", "7"))
        .when(damage == 3, F.concat(F.lit("  "), line("1e2", "", "0.10", " 5")))
        .when(damage == 4, F.lit("ts,server_id,cpu_pct"))
        .when(damage == 5, F.lit("  "))
        .otherwise(good)
    )
    folder = scratch_dir(spark, "quarantined-csv")
    events.select(spelled.alias("value")).write.text(folder)
    return quarantined(read_wide_csv(spark, folder))


def decoded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record in ten spellings: what is read from each, and which are refused."""
    events = wide_from_events(_events(spark, sf_dir), keep=("event_id",))
    text = F.format_string('{"ts":"%s","server_id":"%s","cpu_pct":1.5}', "ts", "server_id")
    kind = F.col("event_id") % 10
    spelled = (
        F.when(kind == 0, F.concat(text, text))
        .when(kind == 1, F.concat(text, F.lit(" garbage")))
        .when(kind == 2, F.translate(text, '"', "'"))
        .when(kind == 3, F.concat(F.lit("\n"), text, F.lit("\n")))
        .when(kind == 4, F.concat(F.lit("\t"), text))
        .when(kind == 5, F.concat(F.lit("["), text, F.lit("]")))
        .when(kind == 6, F.concat_ws(",", text, text))
        .when(kind == 7, F.lit(""))
        .when(kind == 8, F.rtrim(text, F.lit("}")))
        .otherwise(text)
    )
    records = events.select(
        "event_id", F.lit("topic-cpu").alias("topic"), spelled.cast("binary").alias("value")
    )
    decoded = from_records(records, keep=("event_id",))
    return decoded.select("event_id", "ts", "server_id", "cpu_pct", "problem")


# The two alert jobs, step by step


def join_query(rule: AlertRule) -> Query:
    """The inner join, one row per key: joined rows and their aggregates."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        matched = match_readings(*_pair(_wide(spark, sf_dir), rule), rule)
        return weigh(
            matched, rule, F.col("ts"), F.col("server_id"),
            joined_rows().cast("long").alias("joined_rows"),
        ).select(
            "ts", "server_id", "joined_rows",
            merged_value("left", rule).alias("left_value"),
            merged_value("right", rule).alias("right_value"),
        )

    return run


def earliest_query(rule: AlertRule) -> Query:
    """The earliest joined time of day."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pair_summary(*_pair(_wide(spark, sf_dir), rule), rule).select("earliest")

    return run


def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts along each job: readings, joined rows, alert windows."""
    wide = _wide(spark, sf_dir)
    counts = None
    for rule in (CPU_MEM, NET_DISK):
        left, right = _pair(wide, rule)
        stages = pair_summary(left, right, rule).select(
            F.inline(
                F.array(
                    *(
                        F.struct(F.lit(stage).alias("stage"), F.col(stage).alias("n"))
                        for stage in ("left_records", "right_records", "joined_records")
                    )
                )
            )
        )
        windows = metric_windows(left, right, rule).agg(F.count(F.lit(1)).alias("n"))
        both = stages.unionByName(windows.select(F.lit("windows").alias("stage"), "n"))
        named = both.select(F.lit(rule.name).alias("job"), "stage", "n")
        counts = named if counts is None else counts.unionByName(named)
    return counts


def job_report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both alert jobs report over readings of which many have unreadable times."""
    wide = wide_from_events(_events(spark, sf_dir), keep=("event_id",))
    damage = F.col("event_id") % 10
    ts = F.when(damage == 0, "bad").when(damage == 1, "").when(damage != 2, F.col("ts"))
    damaged = wide.withColumn("ts", ts)
    rows = []
    for rule in (CPU_MEM, NET_DISK):
        out = scratch_dir(spark, "reported")
        report = run_alert_job(*_pair(damaged, rule), rule, out, full_counts=True)
        drop_table(spark, out)
        rows.append((
            rule.name, report.left_records, report.right_records, report.left_bad_times,
            report.right_bad_times, report.joined_records, report.earliest, report.windows,
        ))
    return spark.createDataFrame(
        rows, "job string, left_records long, right_records long, left_bad_times long, "
        "right_bad_times long, joined_records long, earliest string, windows long",
    )


def _stamp(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss").alias(column)


def windows_query(rule: AlertRule) -> Query:
    """All windows, no cutoff: raw aggregates and window length."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        everything = replace(rule, cutoff=None)
        windows = metric_windows(*_pair(_wide(spark, sf_dir), rule), everything)
        seconds = F.timestamp_diff("SECOND", "window_start", "window_end")
        return windows.select(
            "server_id", _stamp("window_start"), _stamp("window_end"),
            seconds.alias("seconds"), "left_raw", "right_raw",
        )

    return run


def cutoff_query(rule: AlertRule) -> Query:
    """Windows from the cutoff on, readings filtered beforehand."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        windows = metric_windows(*_pair(_wide(spark, sf_dir), rule), rule)
        return windows.select("server_id", _stamp("window_start"), "left_raw", "right_raw")

    return run


def alerts_query(rule: AlertRule) -> Query:
    """A whole alert job over time-of-day readings."""
    return lambda spark, sf_dir: alerts(*_pair(_wide(spark, sf_dir), rule), rule, ordered=True)


def timestamped_query(rule: AlertRule) -> Query:
    """A job over real timestamps, days kept apart."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wide = wide_from_events(_events(spark, sf_dir), full_timestamp=True)
        return alerts(*_pair(wide, rule), rule)

    return query


def input_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five CPU readings."""
    cpu = split_topic(_wide(spark, sf_dir), "topic-cpu")
    return first_rows(cpu, 5, "ts", "server_id", "cpu_pct")


def alerts_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First twenty alert windows."""
    result = alerts(*_pair(_wide(spark, sf_dir), CPU_MEM), CPU_MEM)
    return first_rows(result, 20, *result.columns)


def csv_roundtrip(rule: AlertRule, schema: StructType) -> Query:
    """A job over landed CSV tables, its result written and read as CSV."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, "alerts-csv")
        wide = _wide(spark, sf_dir)
        pair = []
        for side in (rule.left, rule.right):
            path = f"{folder}/{side.topic}"
            write_table(split_topic(wide, side.topic), path, "csv")
            pair.append(read_landed(spark, path, TOPICS[side.topic], "csv"))
        write_table(alerts(*pair, rule, ordered=True), f"{folder}/alerts", "csv")
        return read_alerts(spark, f"{folder}/alerts", schema)

    return run


def command_line_query(rule: AlertRule, left: str, right: str, schema: StructType) -> Query:
    """A whole job from its command line: CSV inputs, one threshold from a file and one from a flag,
    the result read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, "command-line")
        wide = _wide(spark, sf_dir)
        for side in (rule.left, rule.right):
            write_table(split_topic(wide, side.topic), f"{folder}/{side.topic}", "csv")
        lines = [f"{name}: {value}" for name, value in FILE_THRESHOLDS.items()]
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(
            f"{folder}/thresholds")
        run_from_command_line(rule, left, right, [
            f"--{left}_csv", f"{folder}/{rule.left.topic}",
            f"--{right}_csv", f"{folder}/{rule.right.topic}",
            "--thresholds", f"{folder}/thresholds", f"--{right}_threshold", str(FLAG_THRESHOLD),
            "--out", f"{folder}/alerts",
        ])
        return read_alerts(spark, f"{folder}/alerts", schema)

    return run


def alerts_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The network and disk alerts published as one folder of sorted parts, twice over, and read
    back."""
    result = alerts(*_pair(_wide(spark, sf_dir), NET_DISK), NET_DISK, ordered=True)
    path = scratch_dir(spark, "alerts-folder") + "/alerts"
    for _ in range(2):  # the second replaces the first
        replace_table(result, path, "csv")
    return read_alerts(spark, path, NET_DISK_ALERT)


def alerts_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The network and disk alerts published as one CSV file, twice over, and read back.

    One task writes them, as a job does that is asked for one file.
    """
    result = alerts(*_pair(_wide(spark, sf_dir), NET_DISK), NET_DISK, ordered=True)
    path = scratch_dir(spark, "alerts-file") + "/alerts.csv"
    for _ in range(2):
        publish_single_csv(result, path)
    return read_alerts(spark, path, NET_DISK_ALERT)


# Landings that grow


def _by_instalment(spark: SparkSession, sf_dir: str, day: Column, parts: int, part: int) -> DataFrame:
    """Topic records of one instalment of the events, stamped as messages of a day."""
    events = _events(spark, sf_dir)
    some = events.filter(F.pmod("event_id", F.lit(parts)) == part) if parts > 1 else events
    return to_records(wide_from_events(some)).withColumn("timestamp", day.cast("timestamp"))


def _stream_of(spark: SparkSession, folder: str) -> DataFrame:
    schema = "topic string, value binary, timestamp timestamp"
    return spark.readStream.schema(schema).parquet(folder)


def landed_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records published twice, ten minutes apart, and landed without the second copies."""
    folder = scratch_dir(spark, "landed-once")
    for minutes in (0, 10):
        stamp = F.lit("2024-05-01 12:00:00").cast("timestamp") + F.make_dt_interval(
            mins=F.lit(minutes))
        _by_instalment(spark, sf_dir, stamp, 1, 0).write.mode("append").parquet(f"{folder}/inbox")
        start_landing(
            _stream_of(spark, f"{folder}/inbox"), f"{folder}/table", f"{folder}/checkpoint",
            distinct_within="1 day",
        ).awaitTermination()
    parts = [
        _by_metric(
            read_landed_topic(spark, f"{folder}/table", topic).withColumn("topic", F.lit(topic)))
        for topic in TOPICS
    ]
    return reduce(DataFrame.unionByName, parts)


def message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that each of two runs of the landing reads, counted as its batches report them."""
    folder = scratch_dir(spark, "counted")
    counter = MessageCounter()
    spark.streams.addListener(counter)
    rows = []
    try:
        for part in range(2):
            _by_instalment(spark, sf_dir, F.lit("2024-05-01"), 2, part).write.mode(
                "append").parquet(f"{folder}/inbox")
            rows.append((part, counter.wait(start_landing(
                _stream_of(spark, f"{folder}/inbox"), f"{folder}/table", f"{folder}/checkpoint"))))
    finally:
        spark.streams.removeListener(counter)
    return spark.createDataFrame(rows, "run int, messages long")


def landed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records landed twice, copies and all, and read without the copies."""
    folder = scratch_dir(spark, "landed-twice")
    for day in ("2024-05-01", "2024-05-02"):
        records = _by_instalment(spark, sf_dir, F.lit(day), 1, 0)
        landed = from_records(
            records.withColumn("ingest_date", F.to_date("timestamp")), keep=("ingest_date",))
        landed.write.mode("append").partitionBy("ingest_date", "topic").parquet(folder)
    parts = [
        _by_metric(
            read_landed_topic(spark, folder, topic, distinct=True).withColumn("topic", F.lit(topic)))
        for topic in TOPICS
    ]
    return reduce(DataFrame.unionByName, parts)


def landed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records landed over three days of which two are compacted, read topic by topic."""
    folder = scratch_dir(spark, "compacted")
    for part in range(3):
        records = _by_instalment(spark, sf_dir, F.lit(f"2024-05-0{part + 1}"), 3, part)
        landed = from_records(
            records.withColumn("ingest_date", F.to_date("timestamp")), keep=("ingest_date",))
        landed.write.mode("append").partitionBy("ingest_date", "topic").parquet(f"{folder}/table")
    compact_days(spark, f"{folder}/table", f"{folder}/days", before="2024-05-03")
    parts = [
        _by_metric(
            read_landed_topic(
                spark, f"{folder}/table", topic, compacted=f"{folder}/days"
            ).withColumn("topic", F.lit(topic)))
        for topic in TOPICS
    ]
    return reduce(DataFrame.unionByName, parts)


def incremental_query(rule: AlertRule) -> Query:
    """A job over a landing that grows by a third of the events a day, aggregated day by day."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, "growing")
        for part in range(3):
            _by_instalment(spark, sf_dir, F.lit(f"2024-05-0{part + 1}"), 3, part).write.mode(
                "append").parquet(f"{folder}/inbox")
            start_landing(
                _stream_of(spark, f"{folder}/inbox"), f"{folder}/table", f"{folder}/checkpoint"
            ).awaitTermination()
            add_new_days(spark, f"{folder}/table", f"{folder}/partials", rule)
        return partial_alerts(
            read_partials(spark, f"{folder}/partials", rule), rule, ordered=True)

    return run


def layout_query(rule: AlertRule) -> Query:
    """A job over three days of partial aggregates laid out in buckets, a day at a time."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, "layout")
        name = f"layout_{folder.rpartition('-')[2]}"
        open_layout(spark, name, f"{folder}/buckets", rule, buckets=_tasks(spark))
        for part in range(3):
            records = _by_instalment(spark, sf_dir, F.lit(f"2024-05-0{part + 1}"), 3, part)
            landed = from_records(
                records.withColumn("ingest_date", F.to_date("timestamp")), keep=("ingest_date",))
            landed.write.mode("append").partitionBy("ingest_date", "topic").parquet(
                f"{folder}/table")
            days = add_new_days(spark, f"{folder}/table", f"{folder}/partials", rule)
            lay_out(read_partials(spark, f"{folder}/partials", rule), name, rule, days)
        return layout_alerts(spark, name, rule)

    return run


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Streams


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topic records landed from a stream, read back topic by topic."""
    folder = scratch_dir(spark, "landing")
    records = to_records(wide_from_events(_event_stream(spark, sf_dir)))
    start_landing(records, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    table = f"{folder}/table"
    parts = [
        _by_metric(read_landed_topic(spark, table, topic).withColumn("topic", F.lit(topic)))
        for topic in TOPICS
    ]
    return reduce(DataFrame.unionByName, parts)


def stream_alerts(spark: SparkSession, sf_dir: str, rule: AlertRule) -> DataFrame:
    """Continuous alerts of a rule over all events; a heartbeat closes the last windows."""
    folder = scratch_dir(spark, "continuous")
    stream = wide_from_events(_event_stream(spark, sf_dir), full_timestamp=True)
    beats = open_beats(spark, f"{folder}/beats")
    result = continuous_alerts(*_pair(stream, rule), rule, beats=beats)
    drain_and_close(
        spark,
        lambda: start_alerts(result, f"{folder}/alerts", f"{folder}/check", available_now=True),
        f"{folder}/beats",
    )
    return spark.read.schema(result.schema).parquet(f"{folder}/alerts")


def stream_corrected(spark: SparkSession, sf_dir: str, rule: AlertRule) -> DataFrame:
    """Continuous alerts of events of which every seventh comes after its windows have closed,
    corrected from all events."""
    folder = scratch_dir(spark, "corrected")
    events = _events(spark, sf_dir)
    wide = wide_from_events(events, full_timestamp=True, keep=("event_id",))
    is_late = F.pmod("event_id", F.lit(7)) == 0
    wide.filter(~is_late).write.parquet(f"{folder}/inbox")
    stream = spark.readStream.schema(wide.schema).parquet(f"{folder}/inbox")
    beats = open_beats(spark, f"{folder}/beats")
    result = windows_and_late(*_pair(stream, rule), rule, beats=beats)

    def start():
        return start_alerts(
            result, f"{folder}/out", f"{folder}/check", available_now=True, partition_by=("kind",))

    drain_and_close(spark, start, f"{folder}/beats")
    wide.filter(is_late).write.mode("append").parquet(f"{folder}/inbox")
    start().awaitTermination()
    emitted = read_windows(spark, f"{folder}/out", result.schema)
    late = read_late(spark, f"{folder}/out", result.schema)
    fixed = corrected_windows(late, *_pair(wide, rule), rule)
    add_corrections(fixed, f"{folder}/corrections", run=0)
    corrections = spark.read.parquet(f"{folder}/corrections")
    return format_alerts(latest_windows(emitted, corrections), rule)


QUERIES: dict[str, Query] = {
    "wide_metrics": _wide,
    "wide_csv_scan": wide_csv_scan,
    "wide_csv_skip_first": wide_csv_skip_first,
    "split_cpu": split_query("topic-cpu"),
    "split_mem": split_query("topic-mem"),
    "split_net": split_query("topic-net"),
    "split_disk": split_query("topic-disk"),
    "topic_roundtrip": topic_roundtrip,
    "topic_counts": topic_counts,
    "parse_time_of_day": parse_time_of_day,
    "quarantine_counts": quarantine_counts,
    "quarantined_lines": quarantined_lines,
    "decoded_records": decoded_records,
    "cpu_mem_join": join_query(CPU_MEM),
    "net_disk_join": join_query(NET_DISK),
    "min_event_time": earliest_query(CPU_MEM),
    "net_disk_min_event_time": earliest_query(NET_DISK),
    "job_report_counts": job_report_counts,
    "pipeline_counts": pipeline_counts,
    "cpu_mem_windows": windows_query(CPU_MEM),
    "net_disk_windows": windows_query(NET_DISK),
    "cpu_mem_windows_cutoff": cutoff_query(CPU_MEM),
    "net_disk_windows_cutoff": cutoff_query(NET_DISK),
    "cpu_mem_alerts": alerts_query(CPU_MEM),
    "net_disk_alerts": alerts_query(NET_DISK),
    "cpu_mem_alerts_timestamped": timestamped_query(CPU_MEM),
    "net_disk_alerts_timestamped": timestamped_query(NET_DISK),
    "input_preview": input_preview,
    "alerts_preview": alerts_preview,
    "alerts_csv_roundtrip": csv_roundtrip(CPU_MEM, CPU_MEM_ALERT),
    "net_disk_alerts_csv_roundtrip": csv_roundtrip(NET_DISK, NET_DISK_ALERT),
    "cpu_mem_command_line": command_line_query(CPU_MEM, "cpu", "mem", CPU_MEM_ALERT),
    "net_disk_command_line": command_line_query(NET_DISK, "net", "disk", NET_DISK_ALERT),
    "alerts_published": alerts_published,
    "alerts_single_file": alerts_single_file,
    "landed_deduplicated": landed_deduplicated,
    "message_counts": message_counts,
    "landed_distinct": landed_distinct,
    "landed_compacted": landed_compacted,
    "incremental_cpu_mem_alerts": incremental_query(CPU_MEM),
    "incremental_net_disk_alerts": incremental_query(NET_DISK),
    "layout_cpu_mem_alerts": layout_query(CPU_MEM),
    "layout_net_disk_alerts": layout_query(NET_DISK),
    "stream_landing": stream_landing,
    "stream_cpu_mem_alerts": lambda spark, sf_dir: stream_alerts(spark, sf_dir, CPU_MEM),
    "stream_net_disk_alerts": lambda spark, sf_dir: stream_alerts(spark, sf_dir, NET_DISK),
    "stream_cpu_mem_corrected": lambda spark, sf_dir: stream_corrected(spark, sf_dir, CPU_MEM),
    "stream_net_disk_corrected": lambda spark, sf_dir: stream_corrected(spark, sf_dir, NET_DISK),
}
