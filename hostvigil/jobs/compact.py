"""Rewrite closed days of a landing into few sorted files."""

from __future__ import annotations

import argparse

from hostvigil.plans.compaction import compact_days
from hostvigil.session import build_session


def main(argv: list[str] | None = None) -> None:
    """Run the job from its command line."""
    parser = argparse.ArgumentParser(prog="compact")
    parser.add_argument("--table", required=True, help="landing table")
    parser.add_argument("--compacted", required=True, help="folder of the compacted days")
    parser.add_argument("--before", help="first day left alone, yyyy-MM-dd; today if not given")
    args = parser.parse_args(argv)

    spark = build_session("hostvigil compact")
    done = compact_days(spark, args.table, args.compacted, args.before)
    print(f"compacted {len(done)} days of topics")


if __name__ == "__main__":
    main()
