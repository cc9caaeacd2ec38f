"""Sink and source plumbing that needs no live service."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation

from tidemark.operators.summary import ingest_summary, observe_ingest
from tidemark.operators.validate import with_reject_reason, write_split
from tidemark.schema import EVENT_SCHEMA
from tidemark.session import cluster_conf
from tidemark.sources.topic import kafka_options
from tidemark.streaming import jobs, sinks


def _events(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i), t, 1, 2, "c", None, Decimal("1.5"), 3, "s")
            for i, t in enumerate(["view", "cart", "remove", "purchase"])]
    return with_reject_reason(spark.createDataFrame(rows, EVENT_SCHEMA))


def test_kafka_options():
    opts = kafka_options("b:9092", max_offsets_per_trigger=100)
    assert opts["subscribe"] == "ecommerce-events" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "100" and opts["kafka.bootstrap.servers"] == "b:9092"


def test_jdbc_sink_retries_then_raises(spark):
    sleeps = []
    sink = sinks.JdbcSink("jdbc:nosuchdriver://nowhere/db", "event_type_counts", driver="no.such.Driver")
    sink.sleep = sleeps.append
    assert sink.options["batchsize"] == "100" and sink.retries == 3
    with pytest.raises(Exception):
        sink(spark.createDataFrame([(1,)], "x int"), 0)
    assert len(sleeps) == 3  # three retries after the first attempt


def test_ingest_summary_and_observation(spark):
    checked = _events(spark)
    (row,) = ingest_summary(checked).collect()
    assert (row.total_records, row.good_records, row.rejected_records) == (4, 3, 1)
    obs = Observation("ingest")
    observed = observe_ingest(checked, obs)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"total_records": 4, "good_records": 3, "rejected_records": 1}


def test_write_split_one_pass(spark, tmp_path):
    out = str(tmp_path / "split")
    write_split(_events(spark), out)
    df = spark.read.parquet(out)
    assert df.filter("outcome = 'good'").count() == 3
    assert [r.reject_reason for r in df.filter("outcome = 'rejected'").collect()] == ["unknown_event_type"]


def test_topic_frame_keys_and_order(spark):
    frame = sinks.topic_frame(_events(spark).filter("reject_reason is null"), ordered=True)
    assert frame.columns == ["key", "value"]
    assert {r.key for r in frame.collect()} == {"3"}


def test_cluster_conf_shape():
    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")


def test_streaming_observed_metrics(spark, tmp_path):
    import json
    import os
    from tidemark.sources.topic import decode_records, read_records
    src = tmp_path / "topic"
    os.makedirs(src)
    good = '{"eventTime":1704067201,"eventType":"view","productId":1,"categoryId":2,"categoryCode":null,' \
           '"brand":null,"price":1,"userId":7,"userSession":"s"}'
    with open(src / "b0.json", "w") as f:
        for v in (good, "{oops"):
            f.write(json.dumps({"partition": 0, "offset": 1, "key": "7", "value": v}) + "\n")
    decoded = observe_ingest(decode_records(read_records(spark, path=str(src))))
    q = jobs.start_passthrough(decoded, sinks.TableSink(str(tmp_path / "out")), str(tmp_path / "ck"),
                               {"availableNow": True})
    q.awaitTermination()
    metrics = [p["observedMetrics"]["ingest"].asDict() for p in q.recentProgress if p["numInputRows"]]
    assert metrics[0] == {"total_records": 2, "good_records": 1, "rejected_records": 1}
