"""Topic records: the event topic read as a stream (or batch) of JSON values.

The production source is Kafka (``format("kafka")``, all of the topic,
from the earliest offset, one checkpoint per consumer so every query keeps
its own progress). Where the connector is not on the classpath the same
records come from files of ``partition, offset, key, value``, in one folder or in a folder for
each partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codec import decode_events
from tidemark.operators.validate import REASON
from tidemark.schema import ENVELOPE_SCHEMA, EVENTS_TOPIC

COORDINATES = ("partition", "offset", "key")


def kafka_options(bootstrap: str, topic: str = EVENTS_TOPIC, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Source options for one topic; ``max_offsets_per_trigger`` bounds replay intake."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra)
    return opts


def read_records(spark: SparkSession, *, path: str | None = None, options: dict | None = None,
                 stream: bool = True, max_files_per_trigger: int | None = None,
                 fmt: str = "json") -> DataFrame:
    """Topic records as ``partition, offset, key, value`` (value as text).

    With ``options`` the Kafka source is used; with ``path`` the records are
    read from envelope files, JSON lines (``fmt="json"``) or columnar
    (``fmt="parquet"``, where ``value`` is a plain column as Kafka delivers
    it, so only the event itself is parsed).
    """
    reader = spark.readStream if stream else spark.read
    if options is not None:
        raw = reader.format("kafka").options(**options).load()
        return raw.select("partition", "offset", F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))
    if path is None:
        raise ValueError("read_records needs a Kafka options dict or a path")
    reader = reader.schema(ENVELOPE_SCHEMA)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(path)


def read_partitions(spark: SparkSession, path: str, partitions: list[int], max_files_per_trigger: int | None = None,
                    fmt: str = "json") -> DataFrame:
    """Records of a folder topic with a folder for each partition, as a stream: every partition is a source of its own.

    ``max_files_per_trigger`` bounds the files of each partition, so a micro-batch takes from all of them.
    """
    merged = None
    for p in partitions:
        reader = spark.readStream.schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", True)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        one = reader.format(fmt).load(f"{path}/partition={p}").withColumn("partition", F.lit(p))
        merged = one if merged is None else merged.unionByName(one)
    return merged


def decode_records(records: DataFrame, strict: bool = True, lenient_numbers: bool = True) -> DataFrame:
    """Records -> canonical events with coordinates, raw value and ``reject_reason``."""
    return decode_events(records, "value", strict=strict, keep=(*COORDINATES, "value"),
                         lenient_numbers=lenient_numbers)


def audit_lines(decoded: DataFrame) -> DataFrame:
    """``partition=.. offset=.. key=.. event=..`` for each accepted record."""
    good = decoded.filter(F.col(REASON).isNull())
    line = F.format_string("partition=%d offset=%d key=%s event=%s", F.col("partition"),
                           F.col("offset"), F.col("key"), F.col("value"))
    return good.select(*COORDINATES, line.alias("line"))


def record_rejects(decoded: DataFrame) -> DataFrame:
    """Dead-letter rows: the raw value with its coordinates and the reason."""
    return decoded.filter(F.col(REASON).isNotNull()).select(
        F.col("value").alias("raw"), "partition", "offset", "key", F.col(REASON).alias("reason"))
