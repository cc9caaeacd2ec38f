"""Command-line jobs, one per entry point of the original pipeline.

    python -m tidemark count-job   --topic-dir DIR | --kafka HOST:PORT  --sink table:PATH ...
    python -m tidemark topn-job    (same options)
    python -m tidemark replay-csv  --csv PATH (--topic-dir DIR | --kafka HOST:PORT) [--files-per-trigger N]
    python -m tidemark count-job   --csv PATH (a replay straight into the counts; also topn-job)
    python -m tidemark consume     --topic-dir DIR | --kafka ...  --audit PATH --rejects PATH
    python -m tidemark manual-requests --requests DIR (--topic-dir DIR | --kafka HOST:PORT) [--rejects PATH]
    python -m tidemark preview-csv --csv PATH
    python -m tidemark orders-state --changes PATH --out PATH

Sinks (at least one; repeatable, fanned out from one computation):
``table:PATH``, ``lines:PATH``, ``jdbc:URL#TABLE`` (credentials from --jdbc-user /
--jdbc-password), ``console`` (lines in the executors' output). Checkpoints
default to the shared folder named by ``spark.checkpoint.dir``, one for each
job, input and target. Master and shuffle partitions are those of
``spark-submit``, unless --master is given.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import sys

from pyspark.sql import functions as F

from tidemark.operators import summary, validate
from tidemark.operators.summary import category_top_n_lines, event_type_count_lines
from tidemark.schema import (CONSUMER_POLL_INTERVAL, EVENTS_TOPIC, IDLE_LIMIT, MANUAL_TOPIC, MAX_DELAY, REPLAY_EVENTS_PER_SECOND,
                             REDELIVERY_HORIZON, REPLAY_FILES, REQUEST_SCHEMA, SINK_FLUSH_INTERVAL, TOP_N, TOPIC_PARTITIONS, WINDOW)
from tidemark.session import build_session, scratch_path
from tidemark.sources import changes, csv_events, topic
from tidemark.sources.requests import normalize_requests
from tidemark.streaming import jobs, ledger, progress, replay, sinks


def _source_args(p: argparse.ArgumentParser, csv: bool = False) -> None:
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--topic-dir", help="folder of records: files, or a folder for each partition")
    if csv:
        src.add_argument("--csv", help="event files, replayed straight into the result")
        p.add_argument("--strict-days", action="store_true", help="CSV: reject a day past the month's end")
        p.add_argument("--multi-line", action="store_true", help="CSV: values may hold line breaks")
    p.add_argument("--topic", default=EVENTS_TOPIC)
    p.add_argument("--max-per-trigger", type=int, default=None,
                   help="records (Kafka) or files per micro-batch")
    p.add_argument("--rate", type=int, default=None,
                   help=f"Kafka: records per second, by one bounded micro-batch a second (the replay's pace is "
                        f"{REPLAY_EVENTS_PER_SECOND}); the bound of a directory is --max-per-trigger files")
    p.add_argument("--topic-format", default="json", choices=["json", "parquet"],
                   help="envelope file format of --topic-dir")


def _stream_args(p: argparse.ArgumentParser) -> None:
    _source_args(p, csv=True)
    p.add_argument("--sink", action="append", required=True, help="table:PATH | lines:PATH | jdbc:URL#TABLE | console")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--checkpoint")
    p.add_argument("--window", default=WINDOW)
    p.add_argument("--delay", default=MAX_DELAY)
    p.add_argument("--trigger", default=None,
                   help=f"'once' (availableNow) or an interval; default {SINK_FLUSH_INTERVAL}")
    p.add_argument("--lax", action="store_true", help="accept unknown JSON properties")
    p.add_argument("--strict-numbers", action="store_true",
                   help='reject quoted ("7") and fractional (1.5) integer fields instead of binding them')
    p.add_argument("--on-error", default="reject", choices=["reject", "fail"],
                   help="reject: set bad records aside; fail: stop on the first one")
    p.add_argument("--rejects", help="table path for dead letters (a companion query)")
    p.add_argument("--once-per-record", metavar="HORIZON", nargs="?", const=REDELIVERY_HORIZON,
                   help=f"count a record that is delivered again once, up to HORIZON behind the newest event (default {REDELIVERY_HORIZON})")
    p.add_argument("--idle", default=IDLE_LIMIT, help="a partition without records for so long holds no window open")


def _records(spark, args):
    if args.kafka:
        most = jobs.replay_trigger(args.rate)[1] if args.rate else args.max_per_trigger
        opts = topic.kafka_options(args.kafka, args.topic, max_offsets_per_trigger=most)
        return topic.read_records(spark, options=opts)
    parts = replay.folder_partitions(spark, args.topic_dir)
    if parts:
        return topic.read_partitions(spark, args.topic_dir, parts, args.max_per_trigger, args.topic_format)
    return topic.read_records(spark, path=args.topic_dir, max_files_per_trigger=args.max_per_trigger,
                              fmt=args.topic_format)


def _trigger(args, default: str = SINK_FLUSH_INTERVAL):
    if args.kafka and args.rate and not args.trigger:
        return jobs.replay_trigger(args.rate)[0]
    if not args.trigger:  # results are flushed on the sink interval by default
        return {"processingTime": default}
    if args.trigger == "once":
        return {"availableNow": True}
    return {"processingTime": args.trigger}


def _sinks(args, render, ck: str):
    built = []
    for spec in args.sink:
        kind, _, target = spec.partition(":")
        if kind == "table":
            built.append(sinks.TableSink(target))
        elif kind == "lines":
            built.append(sinks.LinesSink(target, render))
        elif kind == "jdbc":
            url, _, table = target.partition("#")
            built.append(sinks.JdbcSink(url, table, args.jdbc_user, args.jdbc_password))
        elif kind == "console":
            built.append(sinks.ConsoleSink(render))
        else:
            raise SystemExit(f"unknown sink {spec!r}")
    return built[0] if len(built) == 1 else sinks.FanOut(*built, once=ledger.Once(f"{ck}-sinks"))


def _good_events(spark, args, ck: str):
    """Good events with the input they came by, the names of inputs to wait for, and the dead-letter query (if asked)."""
    waited = ()
    if args.csv:
        raw = csv_events.csv_reader(spark, args.multi_line, stream=True, max_files_per_trigger=args.max_per_trigger).csv(args.csv)
        checked = csv_events.type_csv(raw, not args.strict_days)
        name, rejects = F.lit("csv"), checked.where(F.col(validate.REASON).isNotNull()).select("raw_record", validate.REASON)
    else:
        checked = topic.decode_records(_records(spark, args), strict=not args.lax, lenient_numbers=not args.strict_numbers)
        once = checked
        if args.once_per_record:
            once = jobs.without_redelivered(checked.where(F.col(validate.REASON).isNull()), args.once_per_record)
        name, rejects = F.coalesce(F.col("partition").cast("string"), F.lit("")), topic.record_rejects(checked)
        if args.topic_dir:
            waited = tuple(str(p) for p in replay.folder_partitions(spark, args.topic_dir))
    companions = []
    if args.rejects:
        companions.append(jobs.start_passthrough(rejects, sinks.TableSink(args.rejects), f"{ck}-rejects", _trigger(args)))
    kept = checked if args.csv else once
    good = validate.split(kept.withColumn(progress.INPUT, name), on_error=args.on_error, keep=(progress.INPUT,)).good
    return good, waited, companions


def _checkpoint(spark, args, job: str, *identity) -> str:
    """The given checkpoint, or one in the shared folder named by job, input and targets."""
    if args.checkpoint:
        return args.checkpoint
    name = hashlib.sha1(json.dumps([str(i) for i in identity]).encode()).hexdigest()[:16]
    return scratch_path(spark, "checkpoints", f"{job}-{name}", unique=False)


def _counting(spark, args, job: str, start) -> None:
    """Run a windowed job to its end (if it has one) and print its totals, which outlast a restart."""
    ck = _checkpoint(spark, args, job, args.kafka or args.topic_dir or args.csv, args.topic, *sorted(args.sink))
    good, waited, companions = _good_events(spark, args, ck)
    query, counts = start(good, ck, dict(length=args.window, delay=args.delay, idle=args.idle, expected=waited, trigger=_trigger(args)))
    try:
        progress.run(query, counts, *companions)
    finally:
        print(json.dumps(counts.totals(spark)))


def count_job(spark, args) -> None:
    _counting(spark, args, "count-job", lambda good, ck, opts: progress.start_event_type_counts(
        good, _sinks(args, event_type_count_lines, ck), ck, query_name="event_type_counts", **opts))


def topn_job(spark, args) -> None:
    _counting(spark, args, "topn-job", lambda good, ck, opts: progress.start_category_top_n(
        good, _sinks(args, category_top_n_lines, ck), ck, n=args.n, query_name="category_top_n", **opts))


def _publisher(spark, args):
    """Events of a micro-batch -> topic: Kafka, or a folder of records."""
    if args.kafka:
        return replay.KafkaTopic(args.kafka, args.topic)
    return replay.FolderTopic(args.topic_dir, args.partitions, args.topic_format)


def replay_csv(spark, args) -> None:
    """CSV events -> topic (the CSV producer), as a stream of bounded micro-batches (a per-event sleep is not reproduced).

    Reads what is there and stops, or with ``--interval`` goes on, a micro-batch to an interval. Rejected
    rows are skipped, or stop the job with ``--on-error fail``.
    """
    ck = _checkpoint(spark, args, "replay-csv", args.csv, args.kafka or args.topic_dir, args.topic)
    trigger = {"availableNow": True} if args.interval == "once" else {"processingTime": args.interval}
    seen, publish = ledger.Observed(ledger.Ledger(spark, f"{ck}-totals")), _publisher(spark, args)

    def published(events, batch_id):
        publish(events, batch_id)
        for sent in seen.enter(batch_id):
            if args.report:
                print(json.dumps({"sent": sent}))

    published.targets = getattr(publish, "targets", [])
    jobs.await_all(replay.start_replay(spark, args.csv, published, ck, args.files_per_trigger, trigger, args.multi_line,
                                       not args.strict_days, args.on_error, seen.watch))
    if args.report:
        print(json.dumps(seen.ledger.totals()))


def _run_reported(spark, start) -> None:
    """Start queries (the first is the job's own), wait for all, print the job's totals."""
    totals = jobs.Totals(spark)
    try:
        queries = start()
        try:
            jobs.await_all(*queries)
        finally:
            print(json.dumps(totals.of(queries[0])))
    finally:
        totals.close()


def consume(spark, args) -> None:
    """Topic -> audit lines (``partition= offset= key= event=``) and dead letters."""
    decoded = topic.decode_records(_records(spark, args), strict=not args.lax, lenient_numbers=not args.strict_numbers)
    ck = _checkpoint(spark, args, "consume", args.kafka or args.topic_dir, args.topic, args.audit, args.rejects)
    audit = sinks.ConsoleSink(sinks.lines_column) if args.audit == "console" else sinks.TableSink(args.audit)
    parts = [(topic.audit_lines, audit)]
    if args.rejects:
        parts.append((topic.record_rejects, sinks.TableSink(args.rejects)))
    # one query: a micro-batch is read and decoded once for both results
    _run_reported(spark, lambda: [jobs.start_passthrough(
        decoded, sinks.FanOut(*[sinks.Derived(f, s) for f, s in parts]), ck, _trigger(args, CONSUMER_POLL_INTERVAL))])


def manual_requests(spark, args) -> None:
    """Request rows (JSON objects of eight text fields) -> the manual-events topic.

    Each accepted request becomes one event stamped with the server time;
    rejected requests go to ``--rejects`` with their reason.
    """
    reader = spark.readStream if args.stream else spark.read
    requests = reader.schema(REQUEST_SCHEMA).json(args.requests)
    checked = normalize_requests(requests)
    publish = _publisher(spark, args)

    def write(batch, batch_id: int) -> None:
        batch.persist()
        try:
            publish(validate.split(batch).good, batch_id)
            if args.rejects:
                sinks.TableSink(args.rejects)(validate.split(batch).rejects, batch_id)
        finally:
            batch.unpersist()

    if args.stream:
        ck = _checkpoint(spark, args, "manual-requests", args.requests, args.kafka or args.topic_dir, args.topic)
        jobs.await_all(jobs.start_passthrough(checked, write, ck, {"availableNow": True} if args.once else None))
    else:
        sinks.refuse_used(spark, getattr(publish, "targets", ()))
        write(checked, 0)


def preview_csv(spark, args) -> None:
    checked = csv_events.read_csv_events(spark, args.csv, args.multi_line, not args.strict_days, position=True)
    good = validate.split(checked, keep=(csv_events.POSITION,)).good
    for row in summary.preview(good, args.rows, (csv_events.POSITION,)).drop(csv_events.POSITION).collect():  # args.rows rows
        print(row)
    print(json.dumps(summary.ingest_summary(checked).first().asDict()))


def orders_state(spark, args) -> None:
    changes.current_state(spark.read.parquet(args.changes)).write.mode("overwrite").parquet(args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("count-job")
    _stream_args(c)
    t = sub.add_parser("topn-job")
    _stream_args(t)
    t.add_argument("--n", type=int, default=TOP_N)
    r = sub.add_parser("replay-csv")
    r.add_argument("--csv", required=True)
    dst = r.add_mutually_exclusive_group(required=True)
    dst.add_argument("--kafka")
    dst.add_argument("--topic-dir")
    r.add_argument("--topic", default=EVENTS_TOPIC)
    r.add_argument("--partitions", type=int, default=TOPIC_PARTITIONS)
    r.add_argument("--topic-format", default="json", choices=["json", "parquet"])
    r.add_argument("--multi-line", action="store_true")
    r.add_argument("--strict-days", action="store_true", help="reject a day past the month's end instead of taking its last day")
    r.add_argument("--on-error", default="reject", choices=["reject", "fail"])
    r.add_argument("--files-per-trigger", type=int, default=REPLAY_FILES)
    r.add_argument("--interval", default="once", help="trigger interval, or 'once' to drain and stop")
    r.add_argument("--checkpoint")
    r.add_argument("--report", action="store_true")
    s = sub.add_parser("consume")
    _source_args(s)
    s.add_argument("--audit", required=True, help="table path, or 'console' (the executors' output)")
    s.add_argument("--strict-numbers", action="store_true")
    s.add_argument("--rejects")
    s.add_argument("--checkpoint")
    s.add_argument("--trigger", default=None)
    s.add_argument("--lax", action="store_true")
    m = sub.add_parser("manual-requests")
    m.add_argument("--requests", required=True, help="folder of request JSON files")
    mdst = m.add_mutually_exclusive_group(required=True)
    mdst.add_argument("--kafka")
    mdst.add_argument("--topic-dir")
    m.add_argument("--topic", default=MANUAL_TOPIC)
    m.add_argument("--partitions", type=int, default=TOPIC_PARTITIONS)
    m.add_argument("--topic-format", default="json", choices=["json", "parquet"])
    m.add_argument("--rejects")
    m.add_argument("--stream", action="store_true")
    m.add_argument("--once", action="store_true", help="with --stream: drain and stop")
    m.add_argument("--checkpoint")
    v = sub.add_parser("preview-csv")
    v.add_argument("--csv", required=True)
    v.add_argument("--rows", type=int, default=10)
    v.add_argument("--multi-line", action="store_true")
    v.add_argument("--strict-days", action="store_true")
    o = sub.add_parser("orders-state")
    o.add_argument("--changes", required=True)
    o.add_argument("--out", required=True)
    return p


COMMANDS = {"count-job": count_job, "topn-job": topn_job, "replay-csv": replay_csv, "consume": consume,
            "manual-requests": manual_requests, "preview-csv": preview_csv, "orders-state": orders_state}


def main(argv=None, spark=None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        spark = build_session(args.master)
    COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
