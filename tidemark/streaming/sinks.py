"""Micro-batch sinks (``foreachBatch`` targets) and the topic writer.

Each sink is a callable ``(batch_df, batch_id) -> None``. Table sinks write
a batch to its own ``batch_id=`` partition with overwrite, so a micro-batch
replayed after a failure replaces its first attempt instead of adding to
it: with the checkpoint this gives exactly-once results in the table. A folder
belongs to one checkpoint; `claim` refuses it to another.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codec import encode_event
from tidemark.functions.scalar import user_key
from tidemark.operators.summary import category_top_n_lines, event_type_count_lines
from tidemark.schema import EVENTS_TOPIC, SINK_BATCH_ROWS, SINK_MAX_RETRIES
from tidemark.session import files_under
from tidemark.streaming.ledger import Once

BatchSink = Callable[[DataFrame, int], None]


class TableSink:
    """Files (parquet by default), one overwritten partition per micro-batch."""

    def __init__(self, path: str, fmt: str = "parquet"):
        self.path, self.fmt = path, fmt
        self.targets = [path]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(self.fmt).save(f"{self.path}/batch_id={batch_id}")


class JdbcSink:
    """Append rows to a result table over JDBC, ``batch_rows`` per round trip.

    Retries the whole micro-batch write up to ``retries`` times. A retried
    write can repeat rows a failed attempt already committed (at-least-once,
    as an append-only result table with retries is); dedupe downstream on
    (window_start, key) or use :class:`TableSink` for exactly-once.
    """

    def __init__(self, url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_rows: int = SINK_BATCH_ROWS,
                 retries: int = SINK_MAX_RETRIES, backoff_seconds: float = 1.0):
        self.options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
        if user is not None:
            self.options["user"] = user
        if password is not None:
            self.options["password"] = password
        if driver is not None:
            self.options["driver"] = driver
        self.retries, self.backoff = retries, backoff_seconds
        self.sleep = time.sleep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # kept for the retries, so a retry does not recompute the micro-batch; a batch
        # that an outer sink keeps is left to it
        owner = not batch.is_cached
        if owner:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for attempt in range(self.retries + 1):
                try:
                    batch.write.format("jdbc").options(**self.options).mode("append").save()
                    return
                except Exception:  # noqa: BLE001 - rethrown after the last attempt
                    if attempt == self.retries:
                        raise
                    self.sleep(self.backoff * (attempt + 1))
        finally:
            if owner:
                batch.unpersist()


class LinesSink:
    """Rendered text lines (``render(batch)`` has one string column), one folder per batch."""

    def __init__(self, path: str, render: Callable[[DataFrame], DataFrame]):
        self.path, self.render = path, render
        self.targets = [path]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.render(batch).write.mode("overwrite").text(f"{self.path}/batch_id={batch_id}")


def count_lines_sink(path: str) -> LinesSink:
    return LinesSink(path, event_type_count_lines)


def top_n_lines_sink(path: str) -> LinesSink:
    return LinesSink(path, category_top_n_lines)


def _print_lines(rows) -> None:
    for row in rows:
        print(row[0], flush=True)


class ConsoleSink:
    """Prints every rendered line where it is: to the output of the executor that holds it."""

    def __init__(self, render: Callable[[DataFrame], DataFrame]):
        self.render = render

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.render(batch).foreachPartition(_print_lines)


class FanOut:
    """One result, several sinks, computed once: the batch is persisted for the
    duration of the writes and released afterwards.

    With ``once`` a micro-batch that runs again, as one sink failed, passes over the sinks that have it, so
    an appending sink does not get it twice. (A sink that fails after it has written is not known to have it.)
    """

    def __init__(self, *sinks: BatchSink, once: Once | None = None):
        self.sinks, self.once = sinks, once
        self.targets = [t for s in sinks for t in getattr(s, "targets", ())]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        owner = not batch.is_cached
        if owner:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for i, sink in enumerate(self.sinks):
                if self.once and self.once.done(batch.sparkSession, batch_id, i):
                    continue
                sink(batch, batch_id)
                if self.once:
                    self.once.mark(batch.sparkSession, batch_id, i)
        finally:
            if owner:
                batch.unpersist()


class Derived:
    """A result computed from the micro-batch, into a sink of its own."""

    def __init__(self, compute: Callable[[DataFrame], DataFrame], sink: BatchSink):
        self.compute, self.sink = compute, sink
        self.targets = getattr(sink, "targets", [])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.sink(self.compute(batch), batch_id)


def claim(spark, sink: BatchSink, checkpoint: str) -> None:
    """Refuse file targets that hold another run's batches.

    Batches are numbered from 0 under a new checkpoint; in a folder that an
    earlier checkpoint filled, some would replace its batches and the rest would
    stay beside them.
    """
    if not files_under(spark, f"{checkpoint}/metadata"):
        refuse_used(spark, getattr(sink, "targets", ()))


def refuse_used(spark, targets) -> None:
    """Raise if a folder holds batches already."""
    for target in targets:
        if any("/batch_id=" in name for name, _, _ in files_under(spark, target)):
            raise ValueError(f"{target} holds the batches of another run; continue with its checkpoint or choose a new folder")


def topic_frame(events: DataFrame, ordered: bool = False) -> DataFrame:
    """Events -> ``key, value`` records (key = user id text, value = event JSON).

    Records of one key go to one topic partition (the producer hashes the
    key). ``ordered`` deals the events out by user and sorts each task's by time, so a user's
    events are sent in order by one task: for frames of bounded size, such as a replay's micro-batch.
    """
    frame = events
    if ordered:
        frame = frame.repartition("user_id").sortWithinPartitions("event_time", "user_id")
    return frame.select(user_key("user_id").alias("key"), encode_event().alias("value"))


def write_topic(events: DataFrame, bootstrap: str, topic: str = EVENTS_TOPIC,
                ordered: bool = False, **options: str) -> None:
    """Batch-publish events to a topic, waiting for all in-sync replicas (acks=all)."""
    (topic_frame(events, ordered).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
     .option("kafka.acks", "all").options(**options).save())


def lines_column(batch: DataFrame) -> DataFrame:
    """Identity renderer for frames already holding a ``line`` column."""
    return batch.select(F.col("line"))
