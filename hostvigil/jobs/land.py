"""Land everything the four Kafka topics hold and were not landed before."""

from __future__ import annotations

import argparse

from hostvigil.schemas import TOPICS
from hostvigil.session import build_session
from hostvigil.sinks.tables import write_table
from hostvigil.sources.kafka import stream_topics
from hostvigil.sources.landed import read_landed_topic
from hostvigil.streaming.landing import MessageCounter, start_landing


def main(argv: list[str] | None = None) -> None:
    """Run the job from its command line."""
    parser = argparse.ArgumentParser(prog="land")
    parser.add_argument("--servers", default="broker:9092", help="Kafka bootstrap servers")
    parser.add_argument("--table", required=True, help="landing table")
    parser.add_argument("--checkpoint", required=True, help="folder that remembers what was read")
    parser.add_argument("--csv", help="also write one CSV table per topic under this folder")
    parser.add_argument("--distinct_within",
                        help="leave out records taken in this long ago at most, as '1 day'")
    parser.add_argument("--progress_every", type=int, default=0,
                        help="print the running count each time so many messages were read")
    args = parser.parse_args(argv)

    spark = build_session("hostvigil land")
    counter = MessageCounter(args.progress_every, lambda n: print(f"read {n} messages so far"))
    spark.streams.addListener(counter)
    query = start_landing(
        stream_topics(spark, args.servers), args.table, args.checkpoint,
        distinct_within=args.distinct_within,
    )
    print(f"read {counter.wait(query)} messages")
    spark.streams.removeListener(counter)
    if args.csv:
        for topic in TOPICS:
            write_table(read_landed_topic(spark, args.table, topic), f"{args.csv}/{topic}", "csv")


if __name__ == "__main__":
    main()
