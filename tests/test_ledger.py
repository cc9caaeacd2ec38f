"""Totals and marks that outlast a restart, each sink once, records once, windows read from state."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.apps import main
from tidemark.operators import summary, validate
from tidemark.plans import queries as Q
from tidemark.schema import ENVELOPE_SCHEMA, EVENT_SCHEMA
from tidemark.sources import fixtures, topic
from tidemark.streaming import jobs, progress, sinks
from tidemark.streaming.ledger import Ledger, Once

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def test_totals_add_up_over_processes(spark, tmp_path):
    home = str(tmp_path / "totals")
    assert Ledger(spark, home).totals() == {}
    assert Ledger(spark, home).add(0, {"good": 3}) == ({}, {"good": 3})
    Ledger(spark, home).add(1, {"good": 4, "bad": 1})
    assert Ledger(spark, home).add(1, {"good": 4, "bad": 1})[1] == {"good": 7, "bad": 1}  # ran again
    for n in range(2, 6):
        Ledger(spark, home).add(n, {"good": 1})
    assert Ledger(spark, home).totals() == {"good": 11, "bad": 1}
    assert len(list((tmp_path / "totals").iterdir())) == 2


def test_a_replay_killed_in_the_middle_reports_all_records(spark, tmp_path, capsys, monkeypatch):
    csv = str(tmp_path / "csv")
    events = Q.raw_events(spark, SF)
    for _ in range(2):
        fixtures.in_order(events, csv, 3, 1, lambda e: fixtures.write_event_csv(e, csv, "append"))
    args = ["replay-csv", "--csv", csv, "--topic-dir", str(tmp_path / "topic"), "--files-per-trigger", "1", "--report",
            "--checkpoint", str(tmp_path / "ck")]
    from tidemark.streaming.replay import FolderTopic
    write, calls = FolderTopic.__call__, []

    def dies(self, frame, batch_id):
        calls.append(batch_id)
        if len(calls) == 4:
            raise RuntimeError("killed")
        write(self, frame, batch_id)

    monkeypatch.setattr(FolderTopic, "__call__", dies)
    with pytest.raises(Exception, match="killed"):
        main(args, spark)
    main(args, spark)
    said = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    good = validate.good_events(events).count()
    assert said[-1] == {"total_records": 2000, "good_records": 2 * good, "rejected_records": 2000 - 2 * good}
    assert [x["sent"] for x in said if "sent" in x] == list(range(1000, 2 * good + 1, 1000))
    assert spark.read.json(str(tmp_path / "topic")).count() == 2 * good


def test_each_sink_once_when_the_second_fails_once(spark, tmp_path):
    """An appending sink and one that fails once: the retry does not append again."""
    failures = [RuntimeError("sink is down")]

    def appending(batch, batch_id):
        batch.write.mode("append").parquet(str(tmp_path / "appended"))

    def failing(batch, batch_id):
        if failures:
            raise failures.pop()
        batch.write.mode("append").parquet(str(tmp_path / "second"))

    stream_dir = str(tmp_path / "in")
    spark.range(50).write.parquet(stream_dir)
    feed = lambda: spark.readStream.schema("id long").parquet(stream_dir)
    run = lambda: jobs.await_all(jobs.start_passthrough(
        feed(), sinks.FanOut(appending, failing, once=Once(str(tmp_path / "sinks"))), str(tmp_path / "ck"), {"availableNow": True}))
    with pytest.raises(Exception, match="sink is down"):
        run()
    run()
    assert spark.read.parquet(str(tmp_path / "appended")).count() == spark.read.parquet(str(tmp_path / "second")).count() == 50


def test_progress_marks_over_many_splits(spark, tmp_path):
    spark.range(5000).repartitionByRange(3, "id").sortWithinPartitions("id").write.option("parquet.block.size", "4096").parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = spark.read.parquet(str(tmp_path / "t")).select(
            "id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).where("id % 5 <> 2")
        assert rows.rdd.getNumPartitions() > 3
        got = sorted((r.sent, r.id) for r in summary.progress_marks(rows, 100).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    kept = [i for i in range(5000) if i % 5 != 2]
    assert got == [(n, kept[n - 1]) for n in range(100, 4001, 100)]


def _records(spark, seconds, offset=0):
    rows = [(START + dt.timedelta(seconds=s), "view", i, 7, "a", "b", Decimal("1.5"), 1, "s") for i, s in enumerate(seconds)]
    events = spark.createDataFrame(rows, EVENT_SCHEMA).withColumn("event_id", F.col("product_id") + offset)
    return fixtures.topic_records(events, 1)


def test_records_delivered_again_later_count_once(spark, tmp_path):
    path = str(tmp_path / "topic")
    first = _records(spark, [0, 10, 20, 50])
    first.write.parquet(path)
    first.union(_records(spark, [55, 70], 4)).write.mode("append").parquet(path)  # all of it once more, and two new ones
    nowhere = _records(spark, [200], 9).withColumn("offset", F.lit(None).cast("long"))
    nowhere.union(nowhere).write.mode("append").parquet(path)
    records = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", 8).parquet(path)
    decoded = topic.decode_records(records).where("reject_reason is null")
    good = validate.split(jobs.without_redelivered(decoded).withColumn("input", F.lit("t")), keep=("input",)).good
    query, counts = progress.start_event_type_counts(good, sinks.TableSink(str(tmp_path / "out")), str(tmp_path / "ck"),
                                                     trigger={"availableNow": True})
    progress.run(query, counts)
    got = {r.window_start.minute: r.event_count for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: 5, 1: 1}
    assert counts.open_windows(spark).first().event_count == 2  # without offsets nothing tells the two apart


def test_open_and_closed_windows_add_up(spark, tmp_path):
    path = Q.topic_replica(spark, SF)
    records = topic.read_records(spark, path=path, fmt=Q.TOPIC_FORMAT, max_files_per_trigger=Q._files(spark, SF))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    jobs.await_all(jobs.start_event_type_counts(validate.split(topic.decode_records(records)).good, sinks.TableSink(out), ck,
                                                length="1 day", trigger={"availableNow": True}))
    both = spark.read.parquet(out).drop("batch_id").unionByName(jobs.open_windows(spark, ck))
    from tidemark.operators.windows import event_type_counts
    want = event_type_counts(Q.valid_events(spark, SF), "1 day")
    assert jobs.open_windows(spark, ck).count() > 0
    assert sorted(map(str, both.collect())) == sorted(map(str, want.select(*both.columns).collect()))
