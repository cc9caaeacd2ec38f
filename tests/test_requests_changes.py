"""F6 manual requests and F7 order change rows."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import Row

from tidemark.schema import FORM_DEFAULTS, ORDER_CHANGE_SCHEMA, REQUEST_SCHEMA
from tidemark.sources.changes import StateTable, change_images, current_state
from tidemark.sources.requests import normalize_requests


def _norm(spark, *reqs):
    return normalize_requests(spark.createDataFrame(list(reqs), REQUEST_SCHEMA)).collect()


def test_form_defaults(spark):
    (r,) = _norm(spark, FORM_DEFAULTS)
    assert r.reject_reason is None
    assert (r.event_type, r.product_id, r.category_id) == ("view", 123456, 2053013552326770905)
    assert r.category_code is None and r.brand is None
    assert r.price == Decimal("99.99") and r.user_id == 1
    assert len(r.user_session) == 36 and r.user_session.count("-") == 4
    assert isinstance(r.event_time, dt.datetime)


@pytest.mark.parametrize("blank", ["", "  ", "\t", "\n \r"])
def test_blank_to_null(spark, blank):
    req = list(FORM_DEFAULTS)
    req[3] = blank
    req[4] = blank
    req[7] = "my-session"
    (r,) = _norm(spark, tuple(req))
    assert r.category_code is None and r.brand is None and r.user_session == "my-session"


def test_non_blank_kept(spark):
    req = list(FORM_DEFAULTS)
    req[3], req[4] = " x ", " "  # a non-breaking space is not blank
    (r,) = _norm(spark, tuple(req))
    assert r.category_code == " x " and r.brand == " "


@pytest.mark.parametrize("idx,value,reason", [
    (0, "remove", "unknown_event_type"), (0, None, "unknown_event_type"), (0, "View", "unknown_event_type"),
    (1, "12a", "bad_product_id"), (2, " 1", "bad_category_id"), (5, "x", "bad_price"),
    (6, "", "bad_user_id"), (3, None, "missing_category_code"), (7, None, "missing_user_session"),
])
def test_reject_cases(spark, idx, value, reason):
    req = list(FORM_DEFAULTS)
    req[idx] = value
    (r,) = _norm(spark, tuple(req))
    assert r.reject_reason == reason


def _change(seq, op, oid, status, amount="10.00"):
    return (seq, op, oid, "c", "p", Decimal(amount), status, dt.datetime(2024, 1, 1))


def test_current_state(spark):
    changes = [
        _change(1, "insert", 1, "new"), _change(5, "update", 1, "paid", "12.50"), _change(9, "update", 1, "sent"),
        _change(2, "insert", 2, "new"), _change(6, "delete", 2, "new"),
        _change(3, "insert", 3, "new"), _change(7, "delete", 3, "new"), _change(8, "insert", 3, "again"),
        # out of order arrival: the highest change_seq wins, not the last row
        _change(20, "update", 4, "final"), _change(4, "insert", 4, "new"), _change(10, "update", 4, "mid"),
    ]
    df = spark.createDataFrame(changes, ORDER_CHANGE_SCHEMA)
    got = {r.order_id: (r.status, r.last_change_seq) for r in current_state(df).collect()}
    assert got == {1: ("sent", 9), 3: ("again", 8), 4: ("final", 20)}


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_micro_batch_writes_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "state")
    state = StateTable(path, buckets=8)
    frame = lambda rows: spark.createDataFrame(rows, ORDER_CHANGE_SCHEMA)
    state(frame([_change(i, "insert", i, "new") for i in range(1, 200)]), 0)
    first = _files(path)
    assert len(first) == 8
    state(frame([_change(1000, "update", 7, "paid")]), 1)
    added = _files(path) - first
    assert first < _files(path) and len(added) == 1  # the files of all other buckets keep their names
    before = sorted(map(str, state.read(spark).collect()))
    state(frame([_change(1000, "update", 7, "paid")]), 1)  # the micro-batch runs again
    assert sorted(map(str, state.read(spark).collect())) == before
    state(frame([_change(1001, "delete", 7, "paid"), _change(5, "update", 7, "late")]), 2)
    state(frame([_change(999, "update", 7, "later"), _change(2000, "insert", 500, "new")]), 3)
    state(frame([]), 4)
    got = {r.order_id: r.status for r in state.read(spark).collect()}
    assert got == {**{i: "new" for i in range(1, 200) if i != 7}, 500: "new"}
    seven = [f for f in _files(path) if f.split("/")[1] == sorted(added)[0].split("/")[1]]
    assert len(seven) <= 2  # the last version of a bucket and the one before it


def test_an_uncommitted_micro_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path / "state")
    state = StateTable(path, buckets=2)
    state(spark.createDataFrame([_change(1, "insert", 1, "new")], ORDER_CHANGE_SCHEMA), 0)
    state(spark.createDataFrame([_change(2, "update", 1, "paid")], ORDER_CHANGE_SCHEMA), 1)
    os.remove(os.path.join(path, "batch_id=1", "_SUCCESS"))
    assert [r.status for r in state.read(spark).collect()] == ["new"]
    state(spark.createDataFrame([_change(2, "update", 1, "paid")], ORDER_CHANGE_SCHEMA), 1)
    assert [r.status for r in state.read(spark).collect()] == ["paid"]
    with pytest.raises(FileNotFoundError):
        StateTable(str(tmp_path / "none")).read(spark)


def test_change_images(spark):
    def row(commit, seq, op, status, amount="1.00", order=1):
        return (commit, seq, op, order, "c", "p", Decimal(amount), status, None)

    feed = spark.createDataFrame([
        row(1, 0, "insert", "new"), row(2, 0, "update_before", "new"), row(2, 0, "update_before", "new"), row(2, 0, "update_after", "paid", "2.00"),
        row(2, 1, "update_before", "paid", "2.00"), row(2, 1, "update_after", None, "2.00"),  # a second update in the same commit
        row(2, 0, "update_before", "x", order=2), row(2, 0, "update_after", "x", order=2),  # nothing differs
        row(3, 0, "update_after", "alone", order=3), row(4, 0, "delete", "paid")],
        "commit_seq long, seq int, op string, order_id int, customer_name string, product_name string, amount decimal(10,2), status string, created_at timestamp_ntz")
    got = {(r.commit_seq, r.seq, r.order_id): r for r in change_images(feed).collect()}
    assert len(got) == 6
    assert got[1, 0, 1].op == "insert" and got[1, 0, 1].before is None and got[1, 0, 1].changed is None
    assert got[2, 0, 1].changed == {"status": Row(old="new", new="paid"), "amount": Row(old="1.00", new="2.00")}
    assert got[2, 1, 1].changed == {"status": Row(old="paid", new=None)} and got[2, 0, 2].changed == {}
    assert got[3, 0, 3].before is None and got[3, 0, 3].after.status == "alone" and got[3, 0, 3].changed is None
    assert got[4, 0, 1].op == "delete" and got[4, 0, 1].before.status == "paid" and got[4, 0, 1].after is None
    assert change_images(feed.limit(0)).count() == 0


def test_derived_change_rows_have_the_declared_schema(spark):
    from tidemark.sources.fixtures import order_changes
    df = order_changes(spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ORDER_CHANGE_SCHEMA]
