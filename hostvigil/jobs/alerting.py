"""One alert job: two tables of readings in, one alert table out."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvigil.config import AlertRule, load_thresholds
from hostvigil.operators.counts import observe_groups
from hostvigil.operators.matching import (
    group_readings,
    joined_rows,
    match_groups,
    match_readings,
    merged_value,
    weigh,
)
from hostvigil.operators.preview import first_rows
from hostvigil.operators.quarantine import bad_times, readable_time
from hostvigil.plans.alerts import (
    format_alerts,
    label_windows,
    reachable_pair,
    window_matched,
)
from hostvigil.plans.incremental import add_new_days, partial_windows, read_partials
from hostvigil.schemas import TOPICS
from hostvigil.session import build_session, scratch_dir
from hostvigil.sinks.tables import drop_table, publish_single_csv, replace_table, write_table
from hostvigil.sources.landed import read_landed, read_landed_topic


@dataclass(frozen=True)
class JobReport:
    """What a run saw. All but ``windows`` are counted by the run as it goes and are for reporting
    only: tasks repeated after a lost executor may count twice."""

    left_records: int | None  # all readings; None if only reachable ones were looked at
    right_records: int | None
    joined_records: int
    earliest: str | None  # earliest joined time
    windows: int
    output: str | None  # where the result went; None if no file came out
    left_read: int  # readings the run looked at
    right_read: int
    left_bad_times: int  # unreadable times among these
    right_bad_times: int


def publish(
    labelled: DataFrame, rule: AlertRule, out: str, single_file: bool = False
) -> tuple[int, bool]:
    """Write the alert table of labelled windows to ``out``; how many there are, and whether a
    file or folder came out.

    The unsorted windows are first written to the shared scratch folder, so that sorting starts
    from a small table; an older result stays until the new one is complete.
    """
    spark = labelled.sparkSession
    staged = scratch_dir(spark, rule.name)
    try:
        write_table(labelled, staged)
        stored = spark.read.schema(labelled.schema).parquet(staged)
        windows = stored.count()  # from file footers
        result = format_alerts(stored, rule, ordered=True)
        if single_file:
            return windows, publish_single_csv(result, out)
        replace_table(result, out, "csv")
        return windows, True
    finally:
        drop_table(spark, staged)


def run_incremental_job(
    spark: SparkSession, landing: str, partials: str, rule: AlertRule, out: str,
    single_file: bool = False,
) -> list[date]:
    """Alerts over a landing of which only new days are aggregated; returns these days.

    ``partials`` is the folder of the rule's partial table, kept from run to run.
    """
    days = add_new_days(spark, landing, partials, rule)
    publish(partial_windows(read_partials(spark, partials, rule), rule), rule, out, single_file)
    return days


def run_alert_job(
    left: DataFrame,
    right: DataFrame,
    rule: AlertRule,
    out: str,
    single_file: bool = False,
    full_counts: bool = False,
    quarantine: str | None = None,
) -> JobReport:
    """Compute the alerts in one pass over the inputs and write them as CSV to ``out``.

    ``out`` is a folder of sorted parts, or one file written by one task if ``single_file`` asks for
    it.

    By default readings no kept window can hold are filtered in the scan, and only the rest is
    looked at; ``full_counts`` reads and counts everything. ``quarantine`` names a folder for all
    readings with unreadable times, found in a pass of its own.
    """
    spark = left.sparkSession
    if quarantine:
        write_table(bad_times(left, right, rule), quarantine, "csv")
    if not full_counts:
        left, right = reachable_pair(left, right, rule)
    grouped, seen = observe_groups(group_readings(left, right, rule), "readings")
    matched = match_groups(grouped)
    labelled = label_windows(window_matched(matched, rule), rule)
    windows, written = publish(labelled, rule, out, single_file)
    counts = seen.get
    left_read, right_read = (int(counts[f"{side}_records"] or 0) for side in ("left", "right"))
    earliest = counts["earliest"]
    return JobReport(
        left_records=left_read if full_counts else None,
        right_records=right_read if full_counts else None,
        joined_records=int(counts["joined_records"] or 0),
        earliest=None if earliest is None else str(earliest),
        windows=windows,
        output=out if written else None,
        left_read=left_read,
        right_read=right_read,
        left_bad_times=int(counts["left_bad_times"] or 0),
        right_bad_times=int(counts["right_bad_times"] or 0),
    )


def show_inputs(left: DataFrame, right: DataFrame, rule: AlertRule) -> None:
    """Print schemas and first rows of both inputs and of their join, one row per joined key."""
    for readings in (left, right):
        readings.printSchema()
        first_rows(readings, 5).show(truncate=False)
    matched = match_readings(left, right, rule)
    joined = weigh(
        matched.filter(readable_time(matched)), rule, F.col("ts"), F.col("server_id"),
        joined_rows().alias("joined_rows"),
    ).select(
        "ts", "server_id", "joined_rows",
        merged_value("left", rule).alias(rule.left.metric),
        merged_value("right", rule).alias(rule.right.metric),
    )
    first_rows(joined, 5).show(truncate=False)


def _parser(rule: AlertRule, left: str, right: str) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog=rule.name)
    for side in (left, right):
        parser.add_argument(f"--{side}_csv", required=True, help="readings, see --format")
        parser.add_argument(f"--{side}_threshold", type=float)
    parser.add_argument("--out", required=True, help="result CSV")
    parser.add_argument("--thresholds", help="file of 'name: value' lines; flags win over it")
    parser.add_argument(
        "--format",
        choices=("csv", "parquet", "landing"),
        default="csv",
        help="'landing': both inputs name a table written by the land job",
    )
    parser.add_argument(
        "--single_file", action="store_true",
        help="write one CSV file, in one task, rather than a folder of sorted parts",
    )
    parser.add_argument("--since", help="first day of arrival to read from a landing, yyyy-MM-dd")
    parser.add_argument("--until", help="last day of arrival to read from a landing")
    parser.add_argument("--distinct", action="store_true",
                        help="leave out copies of readings that were landed more than once")
    parser.add_argument("--compacted", help="folder of the landing's compacted days")
    parser.add_argument("--partials",
                        help="folder of aggregates kept between runs: with one landing for both "
                             "inputs, only its new days are read")
    parser.add_argument("--cutoff", default=rule.cutoff,
                        help="earliest window start kept, HH:mm:ss, or 'none'")
    parser.add_argument("--size_seconds", type=int, default=rule.size_seconds)
    parser.add_argument("--slide_seconds", type=int, default=rule.slide_seconds)
    parser.add_argument("--quarantine", help="where to write readings with unreadable times")
    parser.add_argument("--full_counts", action="store_true", help="count readings before cutoff")
    parser.add_argument("--preview", action="store_true", help="show first input and result rows")
    return parser


def _read(spark: SparkSession, path: str, topic: str, args: argparse.Namespace) -> DataFrame:
    if args.format == "landing":
        return read_landed_topic(
            spark, path, topic, args.since, args.until, args.distinct, args.compacted)
    return read_landed(spark, path, TOPICS[topic], args.format)


def main(
    rule: AlertRule, left: str, right: str, argv: list[str] | None = None
) -> JobReport | list[date]:
    """Run a job from its command line; ``left`` and ``right`` prefix the flags of each side."""
    parser = _parser(rule, left, right)
    args = parser.parse_args(argv)
    flags = vars(args)
    landing_only = args.since or args.until or args.distinct or args.partials or args.compacted
    if args.format != "landing" and landing_only:
        parser.error("--since, --until, --distinct, --compacted and --partials need --format "
                     "landing")
    paths = flags[f"{left}_csv"], flags[f"{right}_csv"]
    if args.partials and (
        paths[0] != paths[1] or args.since or args.until or args.distinct or args.preview
        or args.full_counts or args.quarantine
    ):
        parser.error("--partials needs one landing for both inputs, and all of its readings")
    spark = build_session(f"hostvigil {rule.name}")
    if args.thresholds:
        rule = load_thresholds(spark, args.thresholds)[rule.name]
    rule = rule.with_thresholds(flags[f"{left}_threshold"], flags[f"{right}_threshold"])
    rule = replace(
        rule,
        cutoff=None if args.cutoff == "none" else args.cutoff,
        size_seconds=args.size_seconds,
        slide_seconds=args.slide_seconds,
    )

    if args.partials:
        days = run_incremental_job(
            spark, paths[0], args.partials, rule, args.out, args.single_file
        )
        print(f"aggregated {len(days)} days: {', '.join(map(str, days)) or 'none were new'}")
        return days
    left_table = _read(spark, flags[f"{left}_csv"], rule.left.topic, args)
    right_table = _read(spark, flags[f"{right}_csv"], rule.right.topic, args)
    if args.preview:
        show_inputs(left_table, right_table, rule)
    report = run_alert_job(
        left_table, right_table, rule, args.out, args.single_file, args.full_counts,
        args.quarantine,
    )
    print(report)
    if args.preview and report.output:
        written = spark.read.option("header", True).csv(report.output)
        first_rows(written, 20, "server_id", "window_start").show(truncate=False)
    return report
