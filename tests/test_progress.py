"""Progress per input: a lagging input loses nothing, a silent one holds nothing, totals outlast a restart."""

import datetime as dt
import json
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.apps import main
from tidemark.plans import oracles
from tidemark.plans import queries as Q
from tidemark.schema import EVENT_SCHEMA
from tidemark.sources import fixtures
from tidemark.streaming import progress, sinks

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    """Events of (seconds after the start, type, input)."""
    full = [(START + dt.timedelta(seconds=s), kind, 1, 7, "a", "b", Decimal("1.5"), 1, "s", name) for s, kind, name in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", input string")


class Run:
    """Micro-batches by hand, a clock that the test sets, and what the sink got."""

    def __init__(self, spark, home, **options):
        self.spark, self.now, self.got = spark, 1000.0, {}
        self.home, self.options = home, options
        self.open()

    def open(self):
        def sink(batch, batch_id):
            self.got[str(batch_id)] = sorted((int((r.window_start - START).total_seconds()), r.event_type, r.event_count) for r in batch.collect())

        self.counts = progress.CountsByInput(self.home, sink, {"event_type": F.upper("event_type")}, clock=lambda: self.now, **self.options)
        self.counts.spark = self.spark

    def batch(self, n, *rows):
        self.counts(events(self.spark, rows), n)
        return self.got[str(n)]


def test_two_active_inputs_ten_minutes_apart(spark, tmp_path):
    run = Run(spark, str(tmp_path / "w"))
    assert run.batch(0, (600, "view", "fast"), (1, "view", "slow"), (50, "cart", "slow")) == []
    assert run.batch(1, (700, "view", "fast"), (61, "view", "slow")) == []  # 00:01:01 - 5 s has not reached 00:01:00
    assert run.batch(2, (800, "view", "fast"), (65, "view", "slow"), (59, "view", "slow")) == [(0, "CART", 1), (0, "VIEW", 2)]
    assert run.batch(3, (30, "view", "slow"), (610, "view", "slow")) == [(60, "VIEW", 2)]  # 30 is late now
    assert run.counts.totals(spark) == {"events": 10, "late": 1, "watermark": int((START - dt.datetime(1970, 1, 1)).total_seconds() + 605) * 1_000_000}


def test_a_silent_input_holds_nothing_and_comes_back(spark, tmp_path):
    run = Run(spark, str(tmp_path / "w"))
    run.batch(0, (1, "view", "a"), (1, "view", "b"))
    run.now += 10
    assert run.batch(1, (100, "view", "a")) == []  # b may still come
    run.now += 0.5
    assert run.batch(2, (200, "view", "a")) == [(0, "VIEW", 2), (60, "VIEW", 1)]
    assert run.batch(3, (185, "view", "b"), (400, "view", "a")) == []  # b is active again: it holds 00:03 open, at 3:05
    assert run.batch(4, (50, "view", "b"), (245, "view", "b")) == [(180, "VIEW", 2)]
    assert run.counts.totals(spark)["late"] == 1


def test_an_expected_input_is_waited_for(spark, tmp_path):
    run = Run(spark, str(tmp_path / "w"), expected=("a", "b"))
    assert run.batch(0, (600, "view", "a")) == []
    assert run.batch(1, (1, "view", "b"), (700, "view", "a")) == []
    assert run.batch(2, (300, "view", "b")) == [(0, "VIEW", 1)]
    late = Run(spark, str(tmp_path / "x"), expected=("a", "b"))
    late.batch(0, (600, "view", "a"))
    late.now += 11
    assert late.batch(1, (700, "view", "a")) == [(600, "VIEW", 1)]  # b never came


def test_all_idle_follow_the_furthest(spark, tmp_path):
    run = Run(spark, str(tmp_path / "w"))
    run.batch(0, (1, "view", "a"), (130, "cart", "b"))
    run.counts.close_idle()
    assert "0-idle" not in run.got
    run.now += 11
    run.counts.close_idle()
    assert run.got["0-idle"] == [(0, "VIEW", 1)]
    run.counts.close_idle()
    assert run.batch(1, (2, "view", "a"), (200, "cart", "b")) == [] and run.counts.totals(spark)["late"] == 1
    assert [(r.event_type, r.event_count) for r in run.counts.open_windows(spark).orderBy("window_start").collect()] == [("CART", 1), ("CART", 1)]


def test_a_micro_batch_that_runs_again_changes_nothing(spark, tmp_path):
    run = Run(spark, str(tmp_path / "w"))
    run.batch(0, (1, "view", "a"))
    once = run.batch(1, (70, "view", "a"), (2, "cart", "a"))
    run.open()  # another process
    assert run.batch(1, (70, "view", "a"), (2, "cart", "a")) == once == [(0, "CART", 1), (0, "VIEW", 1)]
    assert run.batch(2, (3, "view", "a"), (130, "view", "a")) == [(60, "VIEW", 1)]
    assert run.counts.totals(spark) == run.counts.totals(spark) | {"events": 5, "late": 1}


def test_a_failed_sink_leaves_the_step_before(spark, tmp_path):
    run = Run(spark, str(tmp_path / "w"))
    run.batch(0, (1, "view", "a"))

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    sink, run.counts.sink = run.counts.sink, fail
    with pytest.raises(RuntimeError, match="sink is down"):
        run.counts(events(spark, [(70, "view", "a")]), 1)
    run.counts.sink = sink
    assert run.batch(1, (70, "view", "a")) == [(0, "VIEW", 1)] and run.counts.totals(spark)["events"] == 2


def test_intervals():
    assert [progress.seconds_of(x) for x in ("10 seconds", "1 minute", "250 milliseconds", "2 days")] == [10, 60, 0.25, 172800]
    with pytest.raises(ValueError):
        progress.seconds_of("soon")


def test_the_row_loses_none_where_one_watermark_loses_many(spark):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    want = con.execute(f"select sum(event_count) from ({oracles.ORACLES['stream_lagging_input']})").fetchone()[0]
    assert Q.stream_lagging_input(spark, SF).agg(F.sum("event_count")).first()[0] == want


def _csv_in_order(spark, path, slices=6):
    fixtures.in_order(Q.raw_events(spark, SF), path, slices, 1, lambda e: fixtures.write_event_csv(e, path, "append"))


def _counted(spark, path):
    return spark.read.parquet(path).agg({"event_count": "sum"}).first()[0]


def test_replay_then_count_counts_all_closed_windows(spark, tmp_path, capsys):
    """`replay-csv`, then `count-job` a file of each partition at a time: no event of a closed window is lost."""
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    want = con.execute(f"select sum(event_count) from ({oracles.ORACLES['stream_replay_counts']})").fetchone()[0]
    csv, topic_dir = str(tmp_path / "csv"), str(tmp_path / "topic")
    _csv_in_order(spark, csv)
    main(["replay-csv", "--csv", csv, "--topic-dir", topic_dir, "--files-per-trigger", "2", "--checkpoint", str(tmp_path / "ck")], spark)
    assert len(os.listdir(f"{topic_dir}/partition=0")) == 3  # six files, two to a micro-batch
    main(["count-job", "--topic-dir", topic_dir, "--max-per-trigger", "1", "--sink", f"table:{tmp_path / 'out'}",
          "--trigger", "once", "--checkpoint", str(tmp_path / "ck2")], spark)
    totals = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert _counted(spark, str(tmp_path / "out")) == want and totals["late"] == 0
    main(["count-job", "--csv", csv, "--max-per-trigger", "1", "--sink", f"table:{tmp_path / 'direct'}",
          "--trigger", "once", "--checkpoint", str(tmp_path / "ck3")], spark)
    assert _counted(spark, str(tmp_path / "direct")) == want


def test_a_publish_that_runs_again_replaces_its_records(spark, tmp_path):
    publish = progress_topic(tmp_path, per_file=50)
    some = Q.valid_events(spark, SF)
    publish(some, 0)
    publish(some, 0)
    publish(some.limit(10), 1)
    back = spark.read.json(publish.path)
    assert back.count() == some.count() + 10
    n = spark.read.json(publish.path).where("batch_id = 0").groupBy(F.input_file_name()).count()
    assert n.agg({"count": "max"}).first()[0] <= 50 and n.count() > 4


def progress_topic(tmp_path, per_file):
    from tidemark.streaming.replay import FolderTopic

    return FolderTopic(str(tmp_path / "topic"), records_per_file=per_file)


def test_files_of_a_partition_are_in_order_of_time(spark, tmp_path):
    publish = progress_topic(tmp_path, per_file=30)
    publish(Q.valid_events(spark, SF).repartition(7), 0)
    for p in os.listdir(publish.path):
        if not p.startswith("partition="):
            continue
        folder = os.path.join(publish.path, p, "batch_id=0")
        names = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        times = [float(json.loads(line)["value"].split('"eventTime":')[1].split(",")[0]) for f in names for line in open(os.path.join(folder, f))]
        assert times == sorted(times) and len(names) > 1


def test_a_folder_in_use_is_refused(spark, tmp_path):
    csv, topic_dir = str(tmp_path / "csv"), str(tmp_path / "topic")
    _csv_in_order(spark, csv, 2)
    args = ["replay-csv", "--csv", csv, "--topic-dir", topic_dir, "--checkpoint"]
    main([*args, str(tmp_path / "a")], spark)
    main([*args, str(tmp_path / "a")], spark)  # goes on: nothing new
    n = spark.read.json(topic_dir).count()
    with pytest.raises(ValueError, match="another run"):
        main([*args, str(tmp_path / "b")], spark)
    assert spark.read.json(topic_dir).count() == n


def test_top_n_by_input(spark, tmp_path):
    stream_dir = str(tmp_path / "topic")
    fixtures.write_topic_files(fixtures.topic_records(Q.raw_events(spark, SF)), stream_dir, "parquet")
    from tidemark.operators import topn, validate
    from tidemark.sources import topic

    records = topic.read_records(spark, path=stream_dir, fmt="parquet")
    good = validate.split(topic.decode_records(records).withColumn("input", F.lit("all")), keep=("input",)).good
    out = str(tmp_path / "out")
    progress.run(*progress.start_category_top_n(good, sinks.TableSink(out), str(tmp_path / "ck"), n=2, trigger={"availableNow": True}))
    end = Q.valid_events(spark, SF).agg(F.max("event_time")).first()[0] - dt.timedelta(seconds=5)
    want = topn.category_top_n(Q.valid_events(spark, SF), n=2).where(F.col("window_end") <= F.lit(end))
    assert sorted(map(str, spark.read.parquet(out).drop("batch_id").collect())) == sorted(map(str, want.collect()))
