"""Publish a wide metrics CSV to the four Kafka topics."""

from __future__ import annotations

import argparse

from hostvigil.operators.counts import observe_rows
from hostvigil.operators.quarantine import quarantined, usable
from hostvigil.operators.split import to_records
from hostvigil.session import build_session
from hostvigil.sinks.kafka import write_topics
from hostvigil.sinks.tables import write_table
from hostvigil.sources.wide_csv import read_wide_csv


def main(argv: list[str] | None = None) -> None:
    """Run the job from its command line."""
    parser = argparse.ArgumentParser(prog="publish")
    parser.add_argument("--input", required=True, help="wide CSV")
    parser.add_argument("--servers", default="broker:9092", help="Kafka bootstrap servers")
    parser.add_argument("--strict", action="store_true", help="stop at the first bad line")
    parser.add_argument("--skip_first_record", action="store_true")
    parser.add_argument("--quarantine", help="where to write refused lines")
    args = parser.parse_args(argv)

    spark = build_session("hostvigil publish")
    checked = read_wide_csv(spark, args.input, args.skip_first_record, args.strict)
    readings, seen = observe_rows(usable(checked), "published")
    write_topics(to_records(readings), args.servers)
    print(f"published {seen.get['rows']} readings to each topic")
    if args.quarantine:
        write_table(quarantined(checked), args.quarantine)


if __name__ == "__main__":
    main()
