"""CSV events, header + nine positional columns."""

import datetime as dt
from decimal import Decimal

import pytest

from tidemark.operators.validate import split
from tidemark.sources.csv_events import read_csv_events

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
CAT = "2053013552326770905"


def _read(spark, tmp_path, body, multi_line=False):
    path = tmp_path / "events.csv"
    path.write_text(HEADER + body)
    return read_csv_events(spark, str(path), multi_line=multi_line)


def test_sample_rows(spark, tmp_path):
    body = (f"2019-10-01 00:00:00 UTC,view,1001,{CAT},electronics.smartphone,apple,99.99,1,s-1\n"
            f"2019-10-01 00:00:01 UTC,cart,1002,{CAT},,,0.10,2,s-2\n"
            f'2019-10-01 00:00:02 UTC,purchase,1003,{CAT},"a,b",acme,1e3,3,\n')
    df = _read(spark, tmp_path, body)
    got = {r.product_id: r for r in split(df).good.collect()}
    assert set(got) == {1001, 1002, 1003}
    assert got[1001].event_time == dt.datetime(2019, 10, 1, 0, 0, 0)
    assert got[1001].category_id == 2053013552326770905
    assert got[1001].price == Decimal("99.99")
    assert got[1002].category_code is None and got[1002].brand is None
    assert got[1002].price == Decimal("0.10")
    assert got[1003].category_code == "a,b"
    assert got[1003].price == Decimal("1000")
    assert got[1003].user_session == ""


@pytest.mark.parametrize("line,reason", [
    (f"2019-10-01 00:00:00 UTC,remove,1,{CAT},c,b,1.0,1,s", "unknown_event_type"),
    (f"2019-10-01 00:00:00 UTC,VIEW,1,{CAT},c,b,1.0,1,s", "unknown_event_type"),
    (f"2019-10-01 00:00:00 UTC,view,1,{CAT},c", "short_row"),
    (f"2019-02-32 00:00:00 UTC,view,1,{CAT},c,b,1.0,1,s", "bad_event_time"),
    (f"2019-10-01 00:00:00 UTC,view,1,{CAT},c,b,abc,1,s", "bad_price"),
    (f'2019-10-01 00:00:00 UTC,view," 5 ",{CAT},c,b,1.0,1,s', "bad_product_id"),
    (f"2019-10-01 00:00:00 UTC,view,1.5,{CAT},c,b,1.0,1,s", "bad_product_id"),
    (f"2019-10-01 00:00:00 UTC,view,1,99999999999999999999,c,b,1.0,1,s", "bad_category_id"),
    (f"UTC,view,1,{CAT},c,b,1.0,1,s", "bad_event_time"),
    (f"2019-10-01 00:00:00 XYZW,view,1,{CAT},c,b,1.0,1,s", "bad_event_time"),
    (f'2019-10-01 00:00:00 UTC,view,1,{CAT},"c,d,e",b', "short_row"),
])
def test_reject_cases(spark, tmp_path, line, reason):
    df = _read(spark, tmp_path, line + "\n")
    (r,) = df.collect()
    assert r.reject_reason == reason
    assert split(df).good.count() == 0


@pytest.mark.parametrize("line,check", [
    (f"2019-10-01 00:00:00 UTC,view,1,{CAT},c,b,1.0,1,s,extra", lambda r: r.user_session == "s"),
    (f"2019-10-01 00:00:00 UTC,view,1,{CAT},c,b,1.0,1,,extra", lambda r: r.user_session == ""),
    (f"2019-02-30 00:00:00 UTC,view,1,{CAT},c,b,1.0,1,s", lambda r: r.event_time == dt.datetime(2019, 2, 28)),
    (f"2019-10-01 00:00:00 XYZ,view,1,{CAT},c,b,1.0,1,s",
     lambda r: r.event_time == dt.datetime(2019, 10, 1)),
    (f'2019-10-01 00:00:00 UTC,view,1,{CAT},"q ""dd"" q",b,1.0,1,s',
     lambda r: r.category_code == 'q "dd" q'),
    (f"2019-10-01 00:00:00 UTC,view,1,{CAT},c,b,1.23456,1,s", lambda r: r.price == Decimal("1.23456")),
    (f"2019-10-01 00:00:00 UTC,view,+5,{CAT},c,b,1.0,1,s", lambda r: r.product_id == 5),
    (f"2019-10-01 00:00:00 UTC,view,1,{CAT}, ,b,1.0,1,s", lambda r: r.category_code == " "),
])
def test_accept_cases(spark, tmp_path, line, check):
    df = _read(spark, tmp_path, line + "\n")
    (r,) = df.collect()
    assert r.reject_reason is None
    assert check(r)


def test_quoted_newline_needs_multiline(spark, tmp_path):
    body = f'2019-10-01 00:00:00 UTC,view,1,{CAT},"line1\nline2",b,1.0,1,s\n'
    good = split(_read(spark, tmp_path, body, multi_line=True)).good.collect()
    assert [r.category_code for r in good] == ["line1\nline2"]
    assert split(_read(spark, tmp_path, body, multi_line=False)).good.count() == 0


def test_on_error_fail_raises(spark, tmp_path):
    df = _read(spark, tmp_path, f"2019-10-01 00:00:00 UTC,remove,1,{CAT},c,b,1.0,1,s\n")
    with pytest.raises(Exception, match="unknown_event_type"):
        split(df, on_error="fail").good.collect()


def test_reject_keeps_raw_record(spark, tmp_path):
    df = _read(spark, tmp_path, f"2019-10-01 00:00:00 UTC,remove,1,{CAT},,,1.0,1,s\n")
    (r,) = split(df).rejects.collect()
    assert r.raw_record == f"2019-10-01 00:00:00 UTC,remove,1,{CAT},,,1.0,1,s"


def test_raw_record_parses_again(spark, tmp_path):
    df = _read(spark, tmp_path, f'2019-10-01 00:00:00 UTC,remove,1,{CAT},"a,b","q ""d""",1.0,1,s\n')
    (r,) = split(df).rejects.collect()
    again = tmp_path / "again"
    again.mkdir()
    (r2,) = split(_read(spark, again, r.raw_record + "\n")).rejects.collect()
    assert (r2.category_code, r2.brand, r2.raw_record) == ("a,b", 'q "d"', r.raw_record)


def test_blank_lines_are_skipped(spark, tmp_path):
    body = (f"2019-10-01 00:00:00 UTC,view,1,{CAT},c,b,1.0,1,s\n\n"
            f"2019-10-01 00:00:01 UTC,view,2,{CAT},c,b,1.0,1,s\n")
    df = _read(spark, tmp_path, body)
    assert sorted(r.product_id for r in split(df).good.collect()) == [1, 2]
    assert split(df).rejects.count() == 0


@pytest.mark.parametrize("day,expected", [
    ("2019-02-30", dt.datetime(2019, 2, 28, 1, 2, 3)), ("2020-02-30", dt.datetime(2020, 2, 29, 1, 2, 3)),
    ("2019-04-31", dt.datetime(2019, 4, 30, 1, 2, 3)), ("2019-12-31", dt.datetime(2019, 12, 31, 1, 2, 3)),
    ("2019-13-01", None), ("2019-02-32", None), ("2019-2-01", None),
])
def test_days_past_the_month_end(spark, tmp_path, day, expected):
    path = tmp_path / "e.csv"
    path.write_text(HEADER + f"{day} 01:02:03 UTC,view,1,{CAT},c,b,1.0,1,s\n")
    (strict,) = read_csv_events(spark, str(path), clamp_days=False).collect()
    assert (strict.reject_reason is None) == (day == "2019-12-31")
    (r,) = read_csv_events(spark, str(path)).collect()
    assert r.event_time == expected
    assert (r.reject_reason is None) == (expected is not None)


def test_written_newlines_read_back_with_multiline(spark, tmp_path):
    from tidemark.schema import EVENT_COLUMNS, EVENT_SCHEMA
    from tidemark.sources.fixtures import write_event_csv
    rows = [(dt.datetime(2019, 10, 1, 0, 0, i), "view", i, 7, cat, " b ", Decimal("1.5"), 3, "s")
            for i, cat in enumerate(["two\nlines", 'say "hi", ok', "x\r\ny", "plain"])]
    out = str(tmp_path / "out")
    write_event_csv(spark.createDataFrame(rows, EVENT_SCHEMA), out)
    back = read_csv_events(spark, out, multi_line=True)
    assert back.filter("reject_reason is not null").count() == 0
    got = sorted(tuple(r) for r in back.select(*EVENT_COLUMNS).collect())
    assert got == sorted(rows)
