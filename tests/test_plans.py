"""Plan shapes the design relies on at scale, pinned so a refactor cannot lose them."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.topn import category_top_n
from tidemark.operators.validate import split, with_reject_reason
from tidemark.operators.windows import event_type_counts
from tidemark.plans import queries as Q
from tidemark.sources import changes, csv_events, fixtures, topic

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + qe.optimizedPlan().toString()


def test_counts_pre_aggregate_before_the_shuffle(spark):
    plan = _plan(Q.event_type_counts_1m(spark, SF))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")  # printed top-down
    assert "functions=[count(1)]" in plan


def test_top_n_limits_before_and_after_the_window_shuffle(spark):
    plan = _plan(Q.category_topn_1h(spark, SF))
    assert plan.count("WindowGroupLimit") >= 2
    assert "partial_count" in plan


def test_change_state_pre_aggregates(spark):
    plan = _plan(Q.orders_current_state(spark, SF))
    assert "partial_max" in plan and "Window" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if not n.startswith("stream_")])
def test_no_broadcast_or_cartesian(spark, name):
    plan = _plan(Q.QUERIES[name](spark, SF))
    # these join a row for each file split, which Spark broadcasts where its size allows; records of several lines are gathered up to a bound
    by_split = name in ("csv_multiline_ingest", "ingest_progress_marks")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", *(() if by_split else ("BroadcastExchange", "collect_list"))):
        assert bad not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = Q.event_type_counts_1m(spark, SF)._jdf.queryExecution().executedPlan().toString()
    (schema,) = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan parquet" in line][:1]
    assert "event_id" not in schema
    assert "IsNotNull(ts)" in plan


def test_decode_parses_each_record_once(spark):
    recs = spark.createDataFrame([("{}",)], "value string")
    plan = split(topic.decode_records(recs.select(F.lit(0).alias("partition"), F.lit(0).alias("offset"),
                                                  F.lit("k").alias("key"), "value"))).good
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 2  # decimal-time pass + ISO-time pass (only for records pass 1 rejects)


def test_csv_scan_tokenizes_whole_rows(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("h\n2019-10-01 00:00:00 UTC,view,1,2,,,1\n")
    df = split(csv_events.read_csv_events(spark, str(p))).good
    text = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in text.splitlines() if "FileScan csv" in line][0]
    assert "category_code" in scan and "brand" in scan and "_corrupt_record" in scan
    assert df.count() == 0 and len(df.collect()) == 0


def test_skewed_groups_give_exact_results(spark):
    """A third of all rows in one category, one user and one minute."""
    raw = fixtures.raw_events(spark, SF)
    hot = F.col("event_id") % 3 == 0
    skewed = raw.select(
        "event_id",
        F.when(hot, F.lit(dt.datetime(2024, 1, 1, 12, 0, 30))).otherwise(F.col("event_time")).alias("event_time"),
        *[c for c in raw.columns if c not in ("event_id", "event_time", "category_code", "user_id")],
        F.when(hot, F.lit("hot")).otherwise(F.col("category_code")).alias("category_code"),
        F.when(hot, F.lit(1)).otherwise(F.col("user_id")).alias("user_id"))
    good = split(with_reject_reason(skewed)).good
    rows = good.select("event_time", "event_type", "category_code").collect()

    counts = collections.Counter()
    for r in rows:
        counts[(r.event_time.replace(second=0, microsecond=0), r.event_type.upper())] += 1
    got = {(r.window_start, r.event_type): r.event_count for r in event_type_counts(good).collect()}
    assert got == dict(counts)

    per_window = collections.defaultdict(collections.Counter)
    for r in rows:
        per_window[r.event_time.replace(second=0, microsecond=0)][r.category_code or "unknown"] += 1
    want = set()
    for w, c in per_window.items():
        ranked = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
        want |= {(w, i + 1, k, n) for i, (k, n) in enumerate(ranked)}
    got_top = {(r.window_start, r.rank, r.category_code, r.event_count) for r in category_top_n(good).collect()}
    assert got_top == want
    hot_window = dt.datetime(2024, 1, 1, 12, 0)
    assert (hot_window, 1, "hot", per_window[hot_window]["hot"]) in got_top
    assert per_window[hot_window]["hot"] > len(rows) / 4


def test_change_history_of_one_order_holding_a_third(spark):
    base = changes.current_state  # the same operator on a skewed feed
    rows = [(i, "update", 1, "c", "p", None, f"s{i}", None) for i in range(1, 301)]
    rows += [(i, "insert", i, "c", "p", None, "new", None) for i in range(1000, 1600)]
    from tidemark.schema import ORDER_CHANGE_SCHEMA
    df = spark.createDataFrame(rows, ORDER_CHANGE_SCHEMA).repartition(8)
    state = {r.order_id: r.status for r in base(df).collect()}
    assert state[1] == "s300" and len(state) == 601
