"""Replay of event files as a bounded stream into a topic: Kafka, or a folder of records.

Every micro-batch takes a bounded number of files. Its events are dealt out by topic partition and each
partition is written by one task in the order of time, as a producer sends them; a hot user's events of
one micro-batch are as many as its files hold. A folder has a folder for each partition,
each read as an input of its own, so a reader takes from all partitions in every micro-batch and none waits behind another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.codec import encode_event
from tidemark.functions.scalar import user_key
from tidemark.operators import validate
from tidemark.schema import EVENT_COLUMNS, RECORDS_PER_FILE, REPLAY_FILES, TOPIC_PARTITIONS
from tidemark.session import files_under
from tidemark.sources import csv_events
from tidemark.streaming import jobs, sinks


def partition_of(key: Column, partitions: int) -> Column:
    """The topic partition of a record key: 32 bits of its MD5, modulo the number of partitions."""
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint") % partitions).cast("int")


class FolderTopic:
    """Publishes micro-batches to a folder, ``partition=p/batch_id=n``.

    A micro-batch that runs again replaces its files. A folder belongs to one checkpoint; records have no offset, which
    a broker would give them.
    """

    def __init__(self, path: str, partitions: int = TOPIC_PARTITIONS, fmt: str = "json", records_per_file: int = RECORDS_PER_FILE):
        self.path, self.partitions, self.fmt, self.per_file = path, partitions, fmt, records_per_file
        self.targets = [path]

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        of = partition_of(user_key("user_id"), self.partitions)
        placed = events.withColumn("partition", of).withColumn("batch_id", F.lit(batch_id)).repartition(self.partitions, "partition")
        placed = placed.sortWithinPartitions("partition", "batch_id", "event_time", "user_id")
        (placed.select(user_key("user_id").alias("key"), encode_event().alias("value"), "partition", "batch_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", self.per_file)
         .partitionBy("partition", "batch_id").format(self.fmt).save(self.path))


class KafkaTopic:
    """Publishes micro-batches to Kafka, each user's events in order."""

    def __init__(self, bootstrap: str, topic: str):
        self.bootstrap, self.topic = bootstrap, topic

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        sinks.write_topic(events, self.bootstrap, self.topic, ordered=True)


def start_replay(spark: SparkSession, csv: str, publish, checkpoint: str, files: int = REPLAY_FILES, trigger: dict | None = None,
                 multi_line: bool = False, clamp_days: bool = True, on_error: str = "reject",
                 watch: Callable[[DataFrame, int], DataFrame] = lambda batch, batch_id: batch) -> StreamingQuery:
    """CSV event files, ``files`` to a micro-batch in the order of their arrival, into ``publish``.

    Rejected rows are passed over, or (``on_error="fail"``) the events before the first one are published and the replay
    stops. ``watch`` sees every checked micro-batch.
    """
    raw = csv_events.with_split(csv_events.csv_reader(spark, multi_line, stream=True, max_files_per_trigger=files).csv(csv))

    def replay(batch: DataFrame, batch_id: int) -> None:
        seen = watch(csv_events.with_position(batch), batch_id)
        if on_error != "fail":
            publish(validate.split(seen).good, batch_id)
            return
        good, bad = validate.until_first_error(seen, csv_events.POSITION)
        publish(good.select(*EVENT_COLUMNS), batch_id)
        if bad is not None:
            raise validate.InvalidEvent(f"invalid event: {bad[validate.REASON]} in {bad[csv_events.POSITION]['file']}")

    replay.targets = getattr(publish, "targets", [])
    return jobs.start_passthrough(csv_events.type_csv(raw, clamp_days, tuple(csv_events.FILE)), replay, checkpoint, trigger or {"availableNow": True})


def folder_partitions(spark: SparkSession, path: str) -> list[int]:
    """Partitions that a folder of records has folders for; none if its files lie side by side."""
    parts = {name.rsplit("/partition=", 1)[1].split("/")[0] for name, _, _ in files_under(spark, path) if "/partition=" in name}
    return sorted(int(p) for p in parts if p.isdigit())
