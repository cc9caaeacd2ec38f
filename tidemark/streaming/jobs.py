"""Streaming jobs: decode -> watermark -> tumbling window -> append -> sink.

Late-data rule: a window ``[s, e)`` is final once the watermark
(max event time seen - delay) reaches ``e``; it is emitted exactly once
(append mode) and any later event of it is dropped. Spark's default lets a
late row that arrives in the very micro-batch that closes its window still
count; the jobs start with ``statefulOperator.allowMultiple=false`` (each
has a single stateful operator), which applies the drop at the same
boundary the watermark closes the window.

Idle inputs: the watermark is applied once, after inputs are merged, so it
follows the global maximum and a silent input (or a silent topic partition)
never holds windows open; no idle timeout needs configuring.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.functions.time import to_instant, to_wallclock
from tidemark.operators.topn import top_n_per_window
from tidemark.operators.windows import category_counts, event_type_counts
from tidemark.schema import (MAX_DELAY, REDELIVERY_HORIZON, REPLAY_EVENTS_PER_SECOND, STATE_PARTITIONS, TOP_N,
                             UNKNOWN_CATEGORY, WINDOW)
from tidemark.streaming.sinks import BatchSink, claim

LATE_RULE_CONF = "spark.sql.streaming.statefulOperator.allowMultiple"
# Query starts that change session settings are serialized, so two threads
# starting queries at once never see each other's temporary values.
_START_LOCK = threading.RLock()
INSTANT = "event_instant"


@contextmanager
def start_settings(spark, settings: dict[str, str]):
    """Session settings for starting a query, restored afterwards.

    A streaming query copies the session's settings when it starts, so these
    apply to it alone (and settings recorded in its checkpoint, like the state
    partition count, keep their first value on every restart).
    """
    with _START_LOCK:
        previous = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in previous.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def exact_late_rule(spark, extra: dict[str, str] | None = None):
    """Start queries with the exact drop boundary (plus any ``extra`` settings)."""
    return start_settings(spark, {LATE_RULE_CONF: "false", **(extra or {})})


def merge_inputs(*streams: DataFrame) -> DataFrame:
    """Union several event streams before the (single) watermark."""
    merged = streams[0]
    for other in streams[1:]:
        merged = merged.unionByName(other)
    return merged


def watermarked(events: DataFrame, delay: str = MAX_DELAY) -> DataFrame:
    """Add the event-time instant column and its bounded-out-of-orderness watermark."""
    return events.withColumn(INSTANT, to_instant("event_time")).withWatermark(INSTANT, delay)


def without_redelivered(events: DataFrame, horizon: str = REDELIVERY_HORIZON) -> DataFrame:
    """Events of topic records (``partition, offset, event_time``), each record once however often it is delivered.

    The coordinates of a record are kept until the newest event is ``horizon`` past it; a
    record that comes later than that is dropped, as it cannot be told from one that was counted. A record without
    an offset (of a folder) counts as one of its own.
    """
    at = F.when(F.col("offset").isNotNull(), F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string")))
    marked = events.withColumn(INSTANT, to_instant("event_time")).withWatermark(INSTANT, horizon)
    marked = marked.withColumn("_record", F.coalesce(at, F.expr("uuid()")))
    return marked.dropDuplicatesWithinWatermark(["_record"]).drop("_record", INSTANT)


def open_windows(spark, checkpoint: str, key: str = "event_type") -> DataFrame:
    """Counts of the windows that a count query has not closed yet, read from its state: ``window_start, window_end, <key>, event_count``."""
    state = spark.read.format("statestore").load(checkpoint)
    # the state's columns are named by the plan: the window, then the key; the count alone
    (window, of), (count,) = state.schema["key"].dataType.names, state.schema["value"].dataType.names
    at = F.col("key").getField(window)
    return state.select(to_wallclock(at["start"]).alias("window_start"), to_wallclock(at["end"]).alias("window_end"),
                        F.col("key").getField(of).alias(key), F.col("value").getField(count).alias("event_count"))


def event_type_count_stream(events: DataFrame, length: str = WINDOW, delay: str = MAX_DELAY) -> DataFrame:
    return event_type_counts(watermarked(events, delay), length, time_col=INSTANT)


def category_count_stream(events: DataFrame, length: str = WINDOW, delay: str = MAX_DELAY,
                          fallback: str = UNKNOWN_CATEGORY) -> DataFrame:
    return category_counts(watermarked(events, delay), length, time_col=INSTANT, fallback=fallback)


def _start(frame: DataFrame, sink: BatchSink, checkpoint: str, trigger: dict | None,
           query_name: str | None, state_partitions: int | None = None) -> StreamingQuery:
    """Start an append-mode stateful query.

    ``state_partitions`` fixes the number of state-store partitions (the
    shuffle partitions of the stateful exchange) for the life of the
    checkpoint. Every store commits in every micro-batch, so the number follows
    the keys of the open windows, not the cluster: a few for event types, more
    for categories (`STATE_PARTITIONS`), raised by option for more keys.
    """
    claim(frame.sparkSession, sink, checkpoint)
    writer = (frame.writeStream.outputMode("append").foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    extra = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else None
    with exact_late_rule(frame.sparkSession, extra):
        return writer.start()


def start_event_type_counts(events: DataFrame, sink: BatchSink, checkpoint: str,
                            length: str = WINDOW, delay: str = MAX_DELAY,
                            trigger: dict | None = None, query_name: str | None = None,
                            state_partitions: int | None = None) -> StreamingQuery:
    """Counts per (window, event type), each window written once when it closes."""
    return _start(event_type_count_stream(events, length, delay), sink, checkpoint, trigger, query_name,
                  state_partitions or STATE_PARTITIONS["event_type"])


def start_category_top_n(events: DataFrame, sink: BatchSink, checkpoint: str,
                         length: str = WINDOW, delay: str = MAX_DELAY, n: int = TOP_N,
                         fallback: str = UNKNOWN_CATEGORY, trigger: dict | None = None,
                         query_name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Top-n categories per window.

    The stateful part is the distributed count per (window, category); the
    ranking runs on each micro-batch of closed windows. That is exact
    because a window's counts are all final, and all emitted, in the batch
    where the watermark passes its end.
    """
    counts = category_count_stream(events, length, delay, fallback)

    def rank_then_write(batch: DataFrame, batch_id: int) -> None:
        sink(top_n_per_window(batch, n), batch_id)

    rank_then_write.targets = getattr(sink, "targets", [])
    return _start(counts, rank_then_write, checkpoint, trigger, query_name,
                  state_partitions or STATE_PARTITIONS["category"])


def start_passthrough(frame: DataFrame, sink: BatchSink, checkpoint: str,
                      trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Stateless streams (audit lines, dead letters, change rows) into a batch sink."""
    claim(frame.sparkSession, sink, checkpoint)
    writer = frame.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def replay_trigger(events_per_second: int = REPLAY_EVENTS_PER_SECOND,
                   interval_seconds: int = 1) -> tuple[dict, int]:
    """Bounded-rate replay: a processing-time trigger and the records per trigger
    (``maxOffsetsPerTrigger`` for Kafka) that together give the rate."""
    return {"processingTime": f"{interval_seconds} seconds"}, events_per_second * interval_seconds


class Totals(StreamingQueryListener):
    """Running totals of streaming queries, from every progress report (a query keeps only its last ones).

    Register before the query starts and take it off when done::

        totals = Totals(spark)
        query = ...
        totals.of(query); totals.close()

    ``late_groups`` counts what the stateful operator dropped: rows that were
    pre-aggregated in their task, so one for all late events of a task with
    the same window and key.
    """

    def __init__(self, spark):
        self.spark, self.lock, self.runs = spark, threading.Lock(), {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self._run(event.runId)["ended"] = True

    def _run(self, run_id) -> dict:
        return self.runs.setdefault(str(run_id), {"batches": 0, "input_rows": 0, "late_groups": 0, "watermark": None, "ended": False})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.lock:
            run = self._run(p.runId)
            run["batches"] += 1
            run["input_rows"] += p.numInputRows
            run["late_groups"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            run["watermark"] = dict(p.eventTime or {}).get("watermark", run["watermark"])

    def of(self, query: StreamingQuery, wait_seconds: float = 10.0) -> dict:
        """Totals of a query; of an ended one after its last report has come in."""
        end = time.monotonic() + wait_seconds
        while not query.isActive and time.monotonic() < end:
            with self.lock:
                if self._run(query.runId)["ended"]:
                    break
            time.sleep(0.05)
        with self.lock:
            return {k: v for k, v in self._run(query.runId).items() if k != "ended"}

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def await_all(*queries: StreamingQuery, every: Callable[[], None] | None = None) -> None:
    """Wait for all; if one fails, stop the others and raise its error. ``every`` is called about once a second."""
    try:
        while True:
            if every:
                every()
            running = [q for q in queries if q.isActive]
            for q in queries:
                if not q.isActive and q.exception() is not None:
                    raise q.exception()
            if not running:
                return
            running[0].awaitTermination(1)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
