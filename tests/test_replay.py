"""Replay order, totals, output claims, fresh inputs and starts on a cluster."""

import datetime as dt
import json
import os
import shutil
import subprocess
import sys
from decimal import Decimal

import pytest

from tidemark.apps import main
from tidemark.operators.validate import split
from tidemark.plans import queries as Q
from tidemark.schema import EVENT_SCHEMA
from tidemark.session import build_session, shared_dir
from tidemark.sources import fixtures, topic
from tidemark.streaming import jobs, sinks

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
START = dt.datetime(2024, 1, 1)


def _events(spark, n, users=6):
    rows = [(START + dt.timedelta(seconds=i), "view", i, 7, "a", "b", Decimal("1.5"), i % users, "s") for i in range(n)]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def _counted(spark, path):
    return spark.read.parquet(path).agg({"event_count": "sum"}).first()[0]


def test_totals_outlast_the_retained_reports(spark, tmp_path, capsys):
    topic_dir = tmp_path / "topic"
    fixtures.write_topic_files(fixtures.topic_records(
        _events(spark, 240).withColumn("event_id", Q.F.col("product_id")).repartitionByRange(24, "event_time")), str(topic_dir))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        main(["consume", "--topic-dir", str(topic_dir), "--audit", str(tmp_path / "audit"), "--max-per-trigger", "1",
              "--trigger", "once", "--checkpoint", str(tmp_path / "ck")], spark)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    totals = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert totals["input_rows"] == 240 and totals["batches"] >= 24
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 240


def test_a_new_checkpoint_does_not_mix_with_an_old_table(spark, tmp_path):
    records = fixtures.topic_records(_events(spark, 240).withColumn("event_id", Q.F.col("product_id")))
    fixtures.write_topic_files(records, str(tmp_path / "topic"))
    args = ["count-job", "--topic-dir", str(tmp_path / "topic"), "--sink", f"table:{tmp_path / 'out'}", "--trigger", "once"]
    main([*args, "--checkpoint", str(tmp_path / "ck")], spark)
    main([*args, "--checkpoint", str(tmp_path / "ck")], spark)
    assert _counted(spark, str(tmp_path / "out")) == 180
    with pytest.raises(ValueError, match="another run"):
        main([*args, "--checkpoint", str(tmp_path / "other")], spark)


def test_jobs_have_checkpoints_of_their_own(spark, tmp_path):
    for name, n in (("a", 120), ("b", 240)):
        records = fixtures.topic_records(_events(spark, n).withColumn("event_id", Q.F.col("product_id")))
        fixtures.write_topic_files(records, str(tmp_path / name))
        main(["count-job", "--topic-dir", str(tmp_path / name), "--sink", f"table:{tmp_path / ('out' + name)}",
              "--trigger", "once"], spark)
    assert _counted(spark, str(tmp_path / "outa")) == 60 and _counted(spark, str(tmp_path / "outb")) == 180


def test_console_prints_every_line(tmp_path):
    """2,500 records give 2,500 lines in the output of the executors."""
    topic_dir = tmp_path / "topic"
    topic_dir.mkdir()
    value = '{"eventTime":1,"eventType":"view","productId":1,"categoryId":2,"price":1,"userId":7}'
    with open(topic_dir / "a.json", "w") as f:
        for i in range(2500):
            f.write(json.dumps({"partition": 0, "offset": i, "key": "7", "value": value}) + "\n")
    done = subprocess.run([sys.executable, "-m", "tidemark", "--master", "local[2]", "consume", "--topic-dir", str(topic_dir),
                           "--audit", "console", "--trigger", "once", "--checkpoint", str(tmp_path / "ck")],
                          cwd=ROOT, capture_output=True, text=True, timeout=240)
    printed = done.stdout + done.stderr
    assert done.returncode == 0, printed[-2000:]
    assert sum("partition=0 offset=" in line for line in printed.splitlines()) == 2500


def test_no_job_prints_by_default(spark, tmp_path):
    for cmd in ("count-job", "topn-job", "consume"):
        with pytest.raises(SystemExit):
            main([cmd, "--topic-dir", str(tmp_path)], spark)


def test_a_grown_table_is_read_whole(spark, tmp_path):
    sf = tmp_path / "sf"
    (sf / "events.parquet").mkdir(parents=True)
    shutil.copy("/root/testdata/sf0.001/events.parquet", sf / "events.parquet" / "part-1.parquet")
    first = [Q.record_rejects(spark, str(sf)).count(), Q.ingest_summary(spark, str(sf)).first()[0]]
    shutil.copy("/root/testdata/sf0.001/events.parquet", sf / "events.parquet" / "part-2.parquet")
    assert [Q.record_rejects(spark, str(sf)).count(), Q.ingest_summary(spark, str(sf)).first()[0]] == [2 * n for n in first]


def test_fan_out_keeps_its_cache_over_a_retrying_sink(spark, monkeypatch):
    seen = []
    sink = sinks.JdbcSink("jdbc:none", "t", retries=1)
    sink.sleep = lambda s: None

    class Writer:
        def __getattr__(self, name):
            return lambda *a, **k: self if name != "save" else None

    def watch(batch, batch_id):
        seen.append(batch.storageLevel.useMemory)

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Writer()))
    sinks.FanOut(sink, watch, sink, watch)(spark.range(3), 0)
    assert seen == [True, True]


def test_a_failing_companion_stops_the_job(spark, tmp_path):
    rate = spark.readStream.format("rate").load()
    good = jobs.start_passthrough(rate, lambda b, i: None, str(tmp_path / "a"))

    def fail(batch, batch_id):
        raise RuntimeError("dead letters lost")

    bad = jobs.start_passthrough(rate, fail, str(tmp_path / "b"))
    with pytest.raises(Exception, match="dead letters lost"):
        jobs.await_all(good, bad)
    assert not good.isActive


def test_started_sessions_keep_master_and_partitions(monkeypatch):
    class Builder:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            def call(*args):
                self.calls.append((name, *args))
                return self
            return call

        def getOrCreate(self):
            class Session:
                sparkContext = type("Context", (), {"setLogLevel": staticmethod(lambda level: None)})
            return Session()

    builder = Builder()
    monkeypatch.setattr("tidemark.session.SparkSession", type("S", (), {"builder": builder}))
    build_session()
    assert not any(c[0] == "master" or c[1] == "spark.sql.shuffle.partitions" for c in builder.calls)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    session = type("Session", (), {"sparkContext": Context(), "conf": type("C", (), {"get": lambda self, k, d=None: d})()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_state_stores_do_not_follow_the_cores(spark, tmp_path):
    path = str(tmp_path / "topic")
    fixtures.write_topic_files(fixtures.topic_records(_events(spark, 120).withColumn("event_id", Q.F.col("product_id"))), path)
    good = split(topic.decode_records(topic.read_records(spark, path=path))).good
    for cores in ("2", "256"):
        spark.conf.set("spark.sql.shuffle.partitions", cores)
        q = jobs.start_event_type_counts(good, sinks.TableSink(str(tmp_path / f"o{cores}")), str(tmp_path / f"ck{cores}"),
                                         trigger={"availableNow": True})
        q.awaitTermination()
        assert len(os.listdir(tmp_path / f"ck{cores}" / "state" / "0")) in (4, 5)  # four stores, and a metadata folder
    spark.conf.set("spark.sql.shuffle.partitions", "4")
