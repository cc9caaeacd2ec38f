"""F5 ties and the per-window counts (batch)."""

import datetime as dt

from tidemark.operators.summary import category_top_n_lines, event_type_count_lines
from tidemark.operators.topn import category_top_n
from tidemark.operators.windows import category_counts, event_type_counts


def _events(spark, items):
    """items: (minute, second, type, category) -> minimal event frame."""
    data = [(dt.datetime(2024, 1, 1, 0, m, s), t, c) for m, s, t, c in items]
    return spark.createDataFrame(data, "event_time timestamp_ntz, event_type string, category_code string")


def test_ties_and_unknown_merge(spark):
    cats = ["a"] * 4 + ["b"] * 3 + ["c"] * 3 + [None, "unknown"] + [""] * 2 + ["z"]
    ev = _events(spark, [(0, i, "view", c) for i, c in enumerate(cats)]
                 + [(1, 0, "view", "x"), (1, 1, "cart", "y"), (1, 2, "cart", "y")])
    top = category_top_n(ev)
    got = [(r.window_start.minute, r.rank, r.category_code, r.event_count)
           for r in top.orderBy("window_start", "rank").collect()]
    assert got == [(0, 1, "a", 4), (0, 2, "b", 3), (0, 3, "c", 3), (0, 4, "", 2), (0, 5, "unknown", 2),
                   (1, 1, "y", 2), (1, 2, "x", 1)]
    assert dict(top.dtypes)["rank"] == "int"


def test_event_type_counts_upper_case_and_no_empty_rows(spark):
    ev = _events(spark, [(0, 1, "view", "a"), (0, 2, "view", "a"), (0, 59, "cart", "a"), (2, 0, "purchase", "a")])
    got = sorted((r.window_start, r.window_end, r.event_type, r.event_count)
                 for r in event_type_counts(ev).collect())
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    assert got == [(t(0), t(1), "CART", 1), (t(0), t(1), "VIEW", 2), (t(2), t(3), "PURCHASE", 1)]


def test_window_bounds_ignore_session_zone(spark):
    ev = _events(spark, [(0, 1, "view", "a")])
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        (r,) = event_type_counts(ev, "1 hour").collect()
        assert r.window_start == dt.datetime(2024, 1, 1, 0, 0)
        (line,) = event_type_count_lines(event_type_counts(ev, "1 hour")).collect()
        assert line.line == "[2024-01-01 00:00:00 - 2024-01-01 01:00:00] VIEW: 1"
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_text_lines(spark):
    ev = _events(spark, [(0, 1, "view", "a"), (0, 2, "cart", None)])
    lines = sorted(r.line for r in event_type_count_lines(event_type_counts(ev)).collect())
    assert lines == ["[2024-01-01 00:00:00 - 2024-01-01 00:01:00] CART: 1",
                     "[2024-01-01 00:00:00 - 2024-01-01 00:01:00] VIEW: 1"]
    tl = sorted(r.line for r in category_top_n_lines(category_top_n(ev)).collect())
    assert tl == ["[2024-01-01 00:00:00 - 2024-01-01 00:01:00] #1 a: 1",
                  "[2024-01-01 00:00:00 - 2024-01-01 00:01:00] #2 unknown: 1"]


def test_category_counts_fallback(spark):
    ev = _events(spark, [(0, 1, "view", None), (0, 2, "cart", None)])
    (r,) = category_counts(ev, fallback="n/a").collect()
    assert (r.category_code, r.event_count) == ("n/a", 2)
