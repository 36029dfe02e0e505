"""Landing topic records in a table, once each."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from hostvigil.operators.repeats import drop_stream_repeats
from hostvigil.operators.split import from_records
from hostvigil.session import PREFERRED

_STORE = "spark.sql.streaming.stateStore"
#: State on executors' disks, in memory that all stores of an executor share. Spark's own default
#: holds every key in the heap, some 270 bytes each and twice over once a second batch has come.
STATE_ON_DISK = {
    f"{_STORE}.providerClass": PREFERRED[f"{_STORE}.providerClass"],
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    # Counting all keys reads each one before it is written; progress reports then show no total.
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started meanwhile keep their state on disk, unless the session says otherwise.

    A query keeps the settings it was started with; a checkpoint keeps its kind of store.
    """
    added = [key for key in STATE_ON_DISK if spark.conf.get(key, None) is None]
    for key in added:
        spark.conf.set(key, STATE_ON_DISK[key])
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def start_landing(
    records: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "1 minute",
    distinct_within: str | None = None,
) -> StreamingQuery:
    """Append a stream of (topic, value) to a Parquet table partitioned by day of arrival and topic.

    The day is that of the message's ``timestamp`` if the stream has this column, else of the
    batch. One query lands all topics, refused records included (``problem`` and ``raw`` say
    why), so reading some days of a topic prunes to their partitions. The checkpoint remembers
    what has been read; with ``available_now`` the query ends when everything present at its
    start is landed, else it lands what came once every ``interval``.

    Records published again are landed again, unless ``distinct_within`` names a time (such as
    ``1 day``): a record equal to one taken in at most that long ago is then left out. The state
    for it lies in the checkpoint, so a landing begun without it needs a new one to use it. It is
    kept on disk, unless the session names another kind of store.
    """
    stamped = "timestamp" in records.columns
    arrived = F.to_date("timestamp") if stamped else F.current_date()
    decoded = from_records(records.withColumn("ingest_date", arrived), keep=("ingest_date",))
    if distinct_within is not None:
        decoded = drop_stream_repeats(decoded, distinct_within, arrival=("ingest_date",))
    writer = (
        decoded.writeStream.format("parquet")
        .partitionBy("ingest_date", "topic")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with _state_on_disk(records.sparkSession):
        return writer.trigger(**trigger).start()


class MessageCounter(StreamingQueryListener):
    """Counts the messages that streaming queries read, batch by batch as they report them.

    ``on_count`` is told the running total each time it passes another multiple of ``every``.
    Register it with ``spark.streams.addListener`` before a query starts; batches are counted
    however many end between two looks at the query.
    """

    def __init__(self, every: int = 0, on_count: Callable[[int], None] = print):
        self.every, self.on_count = every, on_count
        self.by_batch: dict[tuple[str, int], int] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def total(self, run: str | None = None) -> int:
        """Messages read so far, by one run of a query or by all."""
        return sum(n for (of, _), n in list(self.by_batch.items()) if run in (None, of))

    def wait(self, query: StreamingQuery, timeout: float = 60) -> int:
        """All that a run read; waits for its end and for the last report of it."""
        query.awaitTermination()
        run = str(query.runId)
        if not self._end_of(run).wait(timeout):
            raise TimeoutError(f"no report of the end of run {run}")
        return self.total(run)

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        before = self.total()
        self.by_batch[str(progress.runId), progress.batchId] = progress.numInputRows
        after = self.total()
        if self.every and after // self.every > before // self.every:
            self.on_count(after)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

