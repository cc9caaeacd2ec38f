"""Batch/stream equivalence on ordered input, and the codec round trip as a property."""

import datetime as dt
import glob
import os
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions.codec import decode_events, encode_event
from tidemark.operators.topn import category_top_n
from tidemark.operators.validate import split, with_reject_reason
from tidemark.operators.windows import event_type_counts
from tidemark.schema import EVENT_COLUMNS, EVENT_SCHEMA
from tidemark.sources import fixtures, topic
from tidemark.streaming import jobs, sinks

SF = "/root/testdata/sf0.001"


def _replay_files(spark, path, n_files=12):
    """The events table as n topic files in event-time order, arriving in that order."""
    records = fixtures.topic_records(fixtures.raw_events(spark, SF))
    records.repartitionByRange(n_files, "offset").sortWithinPartitions("offset").write.json(path)
    for i, f in enumerate(sorted(glob.glob(os.path.join(path, "part-*.json")))):
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    return path


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    path = _replay_files(spark, str(tmp_path / "topic"))
    good = split(topic.decode_records(topic.read_records(spark, path=path, max_files_per_trigger=1))).good
    out_c, out_t = str(tmp_path / "counts"), str(tmp_path / "top")
    once = {"availableNow": True}
    q1 = jobs.start_event_type_counts(good, sinks.TableSink(out_c), str(tmp_path / "ck1"), "1 hour", trigger=once)
    q2 = jobs.start_category_top_n(good, sinks.TableSink(out_t), str(tmp_path / "ck2"), "1 hour", trigger=once)
    q1.awaitTermination()
    q2.awaitTermination()
    assert len([p for p in q1.recentProgress if p["numInputRows"]]) == 12  # one file per micro-batch

    batch_good = split(with_reject_reason(fixtures.raw_events(spark, SF))).good
    closed_before = batch_good.agg({"event_time": "max"}).first()[0] - dt.timedelta(seconds=5)
    want_c = sorted(tuple(r) for r in event_type_counts(batch_good, "1 hour")
                    .filter(f"window_end <= timestamp_ntz'{closed_before}'").collect())
    want_t = sorted(tuple(r) for r in category_top_n(batch_good, "1 hour")
                    .filter(f"window_end <= timestamp_ntz'{closed_before}'").collect())
    got_c = sorted(tuple(r) for r in spark.read.parquet(out_c).drop("batch_id").collect())
    got_t = sorted(tuple(r) for r in spark.read.parquet(out_t).drop("batch_id").collect())
    assert got_c == want_c and len(got_c) > 100
    assert got_t == want_t and len(got_t) > 100


_text = st.one_of(st.none(), st.text(max_size=12))
_event = st.tuples(
    st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)),
    st.sampled_from(["view", "cart", "purchase"]),
    st.integers(-2**63, 2**63 - 1),
    st.integers(-2**63, 2**63 - 1),
    _text, _text,
    st.decimals(min_value=Decimal("-1e19"), max_value=Decimal("1e19"), places=6, allow_nan=False),
    st.integers(-2**63, 2**63 - 1),
    _text,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_event, min_size=1, max_size=30))
def test_encode_decode_round_trip(spark, events):
    df = spark.createDataFrame(events, EVENT_SCHEMA)
    back = decode_events(df.select(encode_event().alias("value")))
    assert back.filter("reject_reason is not null").count() == 0
    got = sorted((tuple(r) for r in back.select(*EVENT_COLUMNS).collect()), key=repr)
    assert got == sorted((tuple(e) for e in df.collect()), key=repr)


_csv_text = st.one_of(st.none(), st.text(st.characters(blacklist_categories=("Cs", "Cc")), max_size=10))
_csv_event = st.tuples(
    st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)).map(
        lambda t: t.replace(microsecond=0)),
    st.sampled_from(["view", "cart", "purchase"]),
    st.integers(-2**63, 2**63 - 1), st.integers(-2**63, 2**63 - 1),
    _csv_text, _csv_text,
    st.decimals(min_value=Decimal("-1e19"), max_value=Decimal("1e19"), places=6, allow_nan=False),
    st.integers(-2**63, 2**63 - 1),
    _csv_text,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_csv_event, min_size=1, max_size=20))
def test_csv_write_read_round_trip(spark, tmp_path_factory, events):
    """Our CSV writer and reader agree; empty category/brand read as NULL, a NULL session as ''."""
    from tidemark.sources.csv_events import read_csv_events
    path = str(tmp_path_factory.mktemp("csv"))
    fixtures.write_event_csv(spark.createDataFrame(events, EVENT_SCHEMA), path + "/out")
    back = read_csv_events(spark, path + "/out")
    assert back.filter("reject_reason is not null").count() == 0
    expect = [(t, ty, p, c, cc or None, b or None, pr, u, s or "") for t, ty, p, c, cc, b, pr, u, s in events]
    got = [tuple(r) for r in back.select(*EVENT_COLUMNS).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
