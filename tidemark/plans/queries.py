"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the tables (or files Spark derives from them) in full.
Streaming queries replay the events table as a topic directory and run a
real Structured Streaming job to completion (``availableNow``), then
return the result table their sink wrote.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import wallclock_micros
from tidemark.operators import summary, topn, validate, windows
from tidemark.schema import (CATEGORY_TOP_N_SCHEMA, EVENT_COLUMNS, EVENT_TYPE_COUNTS_SCHEMA, ORDER_CHANGE_SCHEMA,
                             RECORDS_PER_FILE, TOPIC_PARTITIONS)
from tidemark.session import file_system, files_under, scratch_path
from tidemark.sources import changes, csv_events, fixtures, requests, topic
from tidemark.streaming import jobs, progress, replay, sinks

Query = Callable[[SparkSession, str], DataFrame]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_events(spark, sf_dir)


def checked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with ``reject_reason``."""
    return validate.with_reject_reason(raw_events(spark, sf_dir))


def valid_events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The events table, validated; the good side in canonical columns."""
    return validate.good_events(raw_events(spark, sf_dir)).select(*EVENT_COLUMNS, *keep)


# Bump when a derivation changes so stale derived inputs are never reused.
DERIVED_VERSION = "8"
# A stream reads its table in slices of time, a slice to a micro-batch, each in files of at most so many bytes of the table.
SLICES, FILE_BYTES = 5, 128 * 1024 * 1024


def _files(spark: SparkSession, sf_dir: str, table: str = "events") -> int:
    """Files of a slice: as many tasks decode it, no fewer than a topic has partitions."""
    size = sum(n for _, n, _ in files_under(spark, f"{sf_dir}/{table}.parquet"))
    return max(TOPIC_PARTITIONS, -(-size // (SLICES * FILE_BYTES)))


def _derived(spark: SparkSession, sf_dir: str, table: str, kind: str, write: Callable[[str], object]) -> str:
    """A derived copy of a table as it is now, written unless a complete one is there.

    The folder is named by the names, lengths and modification times of the
    table's files, so a table that has changed gets a new copy. Each attempt
    writes to a folder of its own and marks it when done; no folder is renamed.
    """
    listing = files_under(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")
    digest = hashlib.sha1(repr((DERIVED_VERSION, listing)).encode()).hexdigest()[:16]
    home = scratch_path(spark, "derived", f"{kind}-{digest}", unique=False)
    done = [name for name, _, _ in files_under(spark, home) if name.endswith("/_complete")]
    if done:
        return done[0].rsplit("/", 1)[0]
    path = f"{home}/{uuid.uuid4().hex}"
    write(path)
    fs, mark = file_system(spark, f"{path}/_complete")
    fs.create(mark).close()
    return path


# Topic replicas are columnar envelopes: like Kafka, ``value`` arrives as a plain column.
TOPIC_FORMAT = "parquet"


def _append_records(path: str) -> Callable[[DataFrame], object]:
    return lambda events: fixtures.write_topic_files(fixtures.topic_records(events), path, TOPIC_FORMAT, "append")


def topic_replica(spark: SparkSession, sf_dir: str) -> str:
    """The events table published as topic record files, in the order of time."""
    return _derived(spark, sf_dir, "events", "topic", lambda path: fixtures.in_order(
        raw_events(spark, sf_dir), path, SLICES, _files(spark, sf_dir), _append_records(path)))


def csv_replica(spark: SparkSession, sf_dir: str) -> str:
    """The events table written as event CSV files."""
    return _derived(spark, sf_dir, "events", "csv", lambda p: fixtures.write_event_csv(raw_events(spark, sf_dir), p))


def csv_by_time(spark: SparkSession, sf_dir: str) -> str:
    """The events table as CSV files that arrive in the order of time."""
    return _derived(spark, sf_dir, "events", "csv-by-time", lambda path: fixtures.in_order(
        raw_events(spark, sf_dir), path, SLICES, _files(spark, sf_dir),
        lambda events: fixtures.write_event_csv(events, path, "append")))


def late_topic(spark: SparkSession, sf_dir: str) -> str:
    """As `topic_replica`, but every 50th event arrives after all others."""
    def write(path):
        events = raw_events(spark, sf_dir)
        late, files = F.coalesce(F.col("event_id") % 50 == 7, F.lit(False)), _files(spark, sf_dir)
        fixtures.in_order(events.where(~late), path, SLICES, files, _append_records(path))
        _append_records(path)(events.where(late).repartition(files))

    return _derived(spark, sf_dir, "events", "late-topic", write)


def lagging_topics(spark: SparkSession, sf_dir: str) -> str:
    """Two topics: users with odd ids, and, in twice as many slices, those with even ids. Read slice by slice, the second falls behind."""
    def write(path):
        events, files = raw_events(spark, sf_dir), _files(spark, sf_dir)
        for name, rest, slices in (("ahead", 1, SLICES), ("behind", 0, 2 * SLICES)):
            fixtures.in_order(events.where(F.col("user_id") % 2 == rest), f"{path}/{name}", slices, files, _append_records(f"{path}/{name}"))

    return _derived(spark, sf_dir, "events", "lagging-topics", write)


# --- windowed counts and rankings

def event_type_counts_1m(spark, sf_dir):
    return windows.event_type_counts(valid_events(spark, sf_dir), "1 minute")


def event_type_counts_1h(spark, sf_dir):
    return windows.event_type_counts(valid_events(spark, sf_dir), "1 hour")


def category_counts_1m(spark, sf_dir):
    return windows.category_counts(valid_events(spark, sf_dir), "1 minute")


def category_topn_1m(spark, sf_dir):
    return topn.category_top_n(valid_events(spark, sf_dir), "1 minute")


def category_topn_1h(spark, sf_dir):
    return topn.category_top_n(valid_events(spark, sf_dir), "1 hour")


# --- text renderings

def event_type_count_lines(spark, sf_dir):
    return summary.event_type_count_lines(event_type_counts_1m(spark, sf_dir))


def category_topn_lines(spark, sf_dir):
    return summary.category_top_n_lines(category_topn_1h(spark, sf_dir))


# --- validation, totals, preview

def rejected_events(spark, sf_dir):
    return validate.split(checked_events(spark, sf_dir)).rejects.select("event_id", "event_type", validate.REASON)


def ingest_summary(spark, sf_dir):
    return summary.ingest_summary(checked_events(spark, sf_dir))


def ingest_progress_marks(spark, sf_dir):
    """Every thousandth valid event, as the table's files have them."""
    return summary.progress_marks(validate.good_events(fixtures.raw_events(spark, sf_dir, split=True))).select("sent", "event_id", "event_time")


def events_preview(spark, sf_dir):
    """The first ten events as they stand in the table's files."""
    good = validate.good_events(fixtures.raw_events(spark, sf_dir, position=True))
    return summary.preview(good, order_by=("position",)).select("event_id", *EVENT_COLUMNS)


# --- wire codec and topic records

def decoded_events(spark, sf_dir):
    records = fixtures.topic_records(raw_events(spark, sf_dir))
    return validate.split(topic.decode_records(records)).good


def kafka_payload(spark, sf_dir):
    return sinks.topic_frame(valid_events(spark, sf_dir))


def consumed_audit(spark, sf_dir):
    records = topic.read_records(spark, path=topic_replica(spark, sf_dir), stream=False, fmt=TOPIC_FORMAT)
    return topic.audit_lines(topic.decode_records(records))


def record_rejects(spark, sf_dir):
    records = topic.read_records(spark, path=topic_replica(spark, sf_dir), stream=False, fmt=TOPIC_FORMAT)
    return topic.record_rejects(topic.decode_records(records))


# --- other sources

def csv_ingest(spark, sf_dir):
    return validate.split(csv_events.read_csv_events(spark, csv_replica(spark, sf_dir))).good


def csv_rejects(spark, sf_dir):
    """Rows the CSV stage sets aside: the raw line and the first rule it breaks."""
    checked = csv_events.read_csv_events(spark, csv_replica(spark, sf_dir))
    return validate.split(checked).rejects.select("raw_record", validate.REASON)


def multiline_csv(spark: SparkSession, sf_dir: str) -> str:
    """The events table as CSV files with line breaks and quotes in brands and sessions."""
    return _derived(spark, sf_dir, "events", "csv-lines", lambda p: fixtures.write_event_csv(
        fixtures.with_line_breaks(raw_events(spark, sf_dir)), p))


def csv_multiline_ingest(spark, sf_dir):
    """CSV files whose values hold line breaks, read in splits."""
    return validate.split(csv_events.read_csv_events(spark, multiline_csv(spark, sf_dir), multi_line=True)).good


def csv_with_errors(spark: SparkSession, sf_dir: str) -> str:
    """The valid events as CSV files, some runs of ids with an unknown type."""
    def write(path):
        events = validate.good_events(raw_events(spark, sf_dir))
        broken = F.col("event_id") % 4999 > 700
        fixtures.write_event_csv(events.withColumn("event_type", F.when(broken, "refund").otherwise(F.col("event_type"))), path)

    return _derived(spark, sf_dir, "events", "csv-errors", write)


def csv_until_first_error(spark, sf_dir):
    """The events before the first bad record, in file order: what a run that stops on errors has done."""
    checked = csv_events.read_csv_events(spark, csv_with_errors(spark, sf_dir), position=True)
    return validate.until_first_error(checked)[0].select(*EVENT_COLUMNS)


def manual_requests(spark, sf_dir):
    req = raw_events(spark, sf_dir).select(
        F.col("event_type").alias("eventType"),
        F.col("product_id").cast("string").alias("productId"),
        F.col("category_id").cast("string").alias("categoryId"),
        F.coalesce("category_code", F.lit("")).alias("categoryCode"),
        F.coalesce("brand", F.lit("\t")).alias("brand"),
        F.col("price").cast("string").alias("price"),
        F.col("user_id").cast("string").alias("userId"),
        F.when(F.col("user_id") % 5 == 0, F.lit(" ")).otherwise(F.col("user_session")).alias("userSession"),
    )
    out = requests.normalize_requests(req)
    # the server's time: within an hour of the session's, as UTC wall-clock time
    off = F.abs(wallclock_micros("event_time") - F.unix_micros(F.current_timestamp()))
    return out.select((off < F.lit(3600 * 1_000_000)).alias("stamped_now"), "event_type", "product_id", "category_id", "category_code", "brand", "price",
                      "user_id", F.length("user_session").alias("session_length"), validate.REASON)


def orders_current_state(spark, sf_dir):
    return changes.current_state(fixtures.order_changes(spark, sf_dir))


def order_change_images(spark, sf_dir):
    """The orders' changes, a row each: what the row was, what it is, and the columns that differ."""
    found = changes.change_images(fixtures.order_images(spark, sf_dir))
    show = F.array_join(F.transform(F.array_sort(F.map_keys("changed")), lambda c: F.concat(
        c, F.lit(":"), F.col("changed")[c]["old"], F.lit(">"), F.col("changed")[c]["new"])), ";")
    return found.select("commit_seq", "order_id", "op", F.col("before.amount").alias("amount_before"), F.col("after.amount").alias("amount_after"),
                        F.col("before.status").alias("status_before"), F.col("after.status").alias("status_after"), show.alias("changed"))


# --- streaming (S2, W1-W9, K2/K3 via a table sink)

def _slices_of(spark, sf_dir, path: str) -> DataFrame:
    """A folder of records as a stream, a slice to a micro-batch."""
    return topic.read_records(spark, path=path, stream=True, fmt=TOPIC_FORMAT, max_files_per_trigger=_files(spark, sf_dir))


def _stream_records(spark, sf_dir):
    """The topic replica read as a stream, a slice of time in each micro-batch."""
    return topic.decode_records(_slices_of(spark, sf_dir, topic_replica(spark, sf_dir)))


def _stream_good(spark, sf_dir):
    return validate.split(_stream_records(spark, sf_dir)).good


def _run_to_end(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _read_result(spark, path, schema) -> DataFrame:
    """A sink's result table without its ``batch_id`` partition column."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def stream_event_type_counts(spark, sf_dir):
    out = scratch_path(spark, "results", "event_type_counts")
    q = jobs.start_event_type_counts(
        _stream_good(spark, sf_dir), sinks.TableSink(out), scratch_path(spark, "checkpoints", "etc"),
        trigger={"availableNow": True})
    _run_to_end(q)
    return _read_result(spark, out, EVENT_TYPE_COUNTS_SCHEMA)


def stream_category_topn(spark, sf_dir):
    out = scratch_path(spark, "results", "category_top_n")
    q = jobs.start_category_top_n(
        _stream_good(spark, sf_dir), sinks.TableSink(out), scratch_path(spark, "checkpoints", "ctn"),
        trigger={"availableNow": True})
    _run_to_end(q)
    return _read_result(spark, out, CATEGORY_TOP_N_SCHEMA)


def stream_record_rejects(spark, sf_dir):
    """Dead letters of a running consumer (stateless stream into an idempotent table)."""
    out = scratch_path(spark, "results", "record_rejects")
    q = jobs.start_passthrough(topic.record_rejects(_stream_records(spark, sf_dir)), sinks.TableSink(out),
                               scratch_path(spark, "checkpoints", "rej"), {"availableNow": True})
    _run_to_end(q)
    return spark.read.parquet(out).drop("batch_id")


def stream_consumed_audit(spark, sf_dir):
    """Audit lines of a running consumer."""
    out = scratch_path(spark, "results", "consumed_audit")
    q = jobs.start_passthrough(topic.audit_lines(_stream_records(spark, sf_dir)), sinks.TableSink(out),
                               scratch_path(spark, "checkpoints", "audit"), {"availableNow": True})
    _run_to_end(q)
    return spark.read.parquet(out).drop("batch_id")


def stream_two_consumers(spark, sf_dir):
    """Two consumers of one topic, the second started after the first has read it: each has progress of its own and gets every record."""
    out = scratch_path(spark, "results", "two_consumers")
    for name in ("first", "second"):
        lines = topic.audit_lines(_stream_records(spark, sf_dir)).withColumn("consumer", F.lit(name))
        _run_to_end(jobs.start_passthrough(lines, sinks.TableSink(f"{out}/{name}"), scratch_path(spark, "checkpoints", name), {"availableNow": True}))
    both = [spark.read.parquet(f"{out}/{name}").drop("batch_id") for name in ("first", "second")]
    return both[0].unionByName(both[1]).select("consumer", "partition", "offset", "key")


def stream_replay_counts(spark, sf_dir):
    """CSV files replayed into a topic as `replay-csv` does, and the topic counted as `count-job` does, a file of each partition at a time."""
    topic_dir, ck = scratch_path(spark, "results", "replayed-topic"), scratch_path(spark, "checkpoints", "replay")
    publish = replay.FolderTopic(topic_dir, fmt=TOPIC_FORMAT, records_per_file=RECORDS_PER_FILE)
    jobs.await_all(replay.start_replay(spark, csv_by_time(spark, sf_dir), publish, ck, _files(spark, sf_dir)))
    parts = replay.folder_partitions(spark, topic_dir)
    records = topic.read_partitions(spark, topic_dir, parts, 1, TOPIC_FORMAT)
    good = _named_inputs(topic.decode_records(records), F.col("partition").cast("string"))
    return _counted_by_input(spark, good, "replay_counts", tuple(str(p) for p in parts))


def _named_inputs(decoded: DataFrame, name) -> DataFrame:
    return validate.split(decoded.withColumn(progress.INPUT, name), keep=(progress.INPUT,)).good


def _counted_by_input(spark, good: DataFrame, name: str, expected: tuple[str, ...]) -> DataFrame:
    """The result table of a count job with progress per input, run until its inputs are drained."""
    out = scratch_path(spark, "results", name)
    query, counts = progress.start_event_type_counts(good, sinks.TableSink(out), scratch_path(spark, "checkpoints", name),
                                                     expected=expected, trigger={"availableNow": True})
    progress.run(query, counts)
    return _read_result(spark, out, EVENT_TYPE_COUNTS_SCHEMA)


def stream_lagging_input(spark, sf_dir):
    """Counts of two topics, one of which is days behind the other for most of the run: it holds the windows open, and nothing is late."""
    path = lagging_topics(spark, sf_dir)
    decoded = {n: topic.decode_records(_slices_of(spark, sf_dir, f"{path}/{n}")) for n in ("ahead", "behind")}
    merged = progress.merge_named(**decoded)
    good = validate.split(merged, keep=(progress.INPUT,)).good
    return _counted_by_input(spark, good, "lagging_counts", ("ahead", "behind"))


def redelivered_topic(spark: SparkSession, sf_dir: str) -> str:
    """As `topic_replica`, with every tenth record twice."""
    def write(path):
        events = raw_events(spark, sf_dir)
        again = F.coalesce(F.col("event_id") % 10 == 3, F.lit(False))
        twice = events.withColumn("_n", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_n")
        fixtures.in_order(twice, path, SLICES, _files(spark, sf_dir), _append_records(path))

    return _derived(spark, sf_dir, "events", "redelivered-topic", write)


def stream_redelivered_counts(spark, sf_dir):
    """Counts of a topic that delivers every tenth record twice: each counts once."""
    decoded = topic.decode_records(_slices_of(spark, sf_dir, redelivered_topic(spark, sf_dir)))
    once = jobs.without_redelivered(decoded.where(F.col(validate.REASON).isNull()))
    good = validate.split(once.withColumn(progress.INPUT, F.lit("topic")), keep=(progress.INPUT,)).good
    return _counted_by_input(spark, good, "redelivered_counts", ())


def stream_open_windows(spark, sf_dir):
    """What a count query holds in its state once its input is drained: the counts of the windows it has not closed."""
    out, ck = scratch_path(spark, "results", "open_windows"), scratch_path(spark, "checkpoints", "open")
    _run_to_end(jobs.start_event_type_counts(_stream_good(spark, sf_dir), sinks.TableSink(out), ck, length="1 hour",
                                             trigger={"availableNow": True}))
    return jobs.open_windows(spark, ck)


def stream_late_events(spark, sf_dir):
    """Counts of a stream whose last slice holds late events: those of closed windows are dropped."""
    records = _slices_of(spark, sf_dir, late_topic(spark, sf_dir))
    out = scratch_path(spark, "results", "late_counts")
    _run_to_end(jobs.start_event_type_counts(
        validate.split(topic.decode_records(records)).good, sinks.TableSink(out), scratch_path(spark, "checkpoints", "late"),
        trigger={"availableNow": True}))
    return _read_result(spark, out, EVENT_TYPE_COUNTS_SCHEMA)


def stream_fan_out_lines(spark, sf_dir):
    """The lines of a running count job that also writes its table, from one computation: both, the table rendered afterwards."""
    out = scratch_path(spark, "results", "fan_out")
    _run_to_end(jobs.start_event_type_counts(
        _stream_good(spark, sf_dir), sinks.FanOut(sinks.TableSink(f"{out}/table"), sinks.count_lines_sink(f"{out}/lines")),
        scratch_path(spark, "checkpoints", "fan"), trigger={"availableNow": True}))
    lines = spark.read.schema("value string").text(f"{out}/lines").select(F.lit("lines").alias("sink"), F.col("value").alias("line"))
    rendered = summary.event_type_count_lines(_read_result(spark, f"{out}/table", EVENT_TYPE_COUNTS_SCHEMA))
    return lines.union(rendered.select(F.lit("table"), "line"))


def json_binding_cases(spark, sf_dir):
    """Event records with ids quoted, fractional or missing and times as text, bound by the default rules."""
    records = fixtures.topic_records(raw_events(spark, sf_dir))
    return topic.decode_records(fixtures.binding_cases(records)).select(
        "offset", "event_time", "product_id", "user_id", validate.REASON)


def order_change_replica(spark: SparkSession, sf_dir: str) -> str:
    """The orders table's change rows as files (a change topic)."""
    def write(path):
        fixtures.write_in_order(fixtures.order_changes(spark, sf_dir), F.col("change_seq"), SLICES, _files(spark, sf_dir, "orders"),
                                lambda rows: rows.write.mode("append").parquet(path), f"{path}-slices")

    return _derived(spark, sf_dir, "orders", "order-changes", write)


def stream_orders_current_state(spark, sf_dir):
    """Change rows merged into the order state, a micro-batch at a time."""
    table = scratch_path(spark, "results", "order_state")
    feed = spark.readStream.schema(ORDER_CHANGE_SCHEMA).option("maxFilesPerTrigger", _files(spark, sf_dir, "orders")).parquet(
        order_change_replica(spark, sf_dir))
    q = jobs.start_passthrough(feed, changes.StateTable(table), scratch_path(spark, "checkpoints", "orders"),
                               {"availableNow": True})
    _run_to_end(q)
    return changes.StateTable(table).read(spark)


QUERIES: dict[str, Query] = {
    "event_type_counts_1m": event_type_counts_1m,
    "event_type_counts_1h": event_type_counts_1h,
    "category_counts_1m": category_counts_1m,
    "category_topn_1m": category_topn_1m,
    "category_topn_1h": category_topn_1h,
    "event_type_count_lines": event_type_count_lines,
    "category_topn_lines": category_topn_lines,
    "rejected_events": rejected_events,
    "ingest_summary": ingest_summary,
    "ingest_progress_marks": ingest_progress_marks,
    "events_preview": events_preview,
    "decoded_events": decoded_events,
    "kafka_payload": kafka_payload,
    "consumed_audit": consumed_audit,
    "record_rejects": record_rejects,
    "csv_ingest": csv_ingest,
    "csv_rejects": csv_rejects,
    "csv_multiline_ingest": csv_multiline_ingest,
    "csv_until_first_error": csv_until_first_error,
    "manual_requests": manual_requests,
    "orders_current_state": orders_current_state,
    "order_change_images": order_change_images,
    "stream_event_type_counts": stream_event_type_counts,
    "stream_category_topn": stream_category_topn,
    "stream_record_rejects": stream_record_rejects,
    "stream_consumed_audit": stream_consumed_audit,
    "stream_orders_current_state": stream_orders_current_state,
    "stream_two_consumers": stream_two_consumers,
    "stream_replay_counts": stream_replay_counts,
    "stream_lagging_input": stream_lagging_input,
    "stream_redelivered_counts": stream_redelivered_counts,
    "stream_open_windows": stream_open_windows,
    "stream_late_events": stream_late_events,
    "stream_fan_out_lines": stream_fan_out_lines,
    "json_binding_cases": json_binding_cases,
}
