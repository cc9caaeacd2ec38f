"""event JSON on the wire; decode parity and the encode/decode round trip."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.codec import decode_events, encode_event
from tidemark.operators.validate import split
from tidemark.schema import EVENT_COLUMNS, EVENT_SCHEMA

BASE = ('"eventType":"view","productId":1,"categoryId":2053013552326770905,'
        '"categoryCode":"electronics.smartphone","brand":null,"price":99.90,"userId":1,"userSession":"s-1"')


def _decode(spark, values, strict=True, lenient=True):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return decode_events(df, strict=strict, keep=("value",), lenient_numbers=lenient)


def test_wire_example(spark):
    (r,) = _decode(spark, ['{"eventTime":1569888000.250000000,' + BASE + '}']).collect()
    assert r.reject_reason is None
    assert r.event_time == dt.datetime(2019, 10, 1, 0, 0, 0, 250000)
    assert r.category_id == 2053013552326770905
    assert r.brand is None and r.price == Decimal("99.90")


@pytest.mark.parametrize("time_text", ['1569888000', '"2019-10-01T00:00:00Z"', '1569888000.000000000'])
def test_time_encodings(spark, time_text):
    (r,) = _decode(spark, ['{"eventTime":' + time_text + ',' + BASE + '}']).collect()
    assert r.reject_reason is None
    assert r.event_time == dt.datetime(2019, 10, 1)


@pytest.mark.parametrize("value,reason", [
    ("{not json", "malformed_json"),
    ("", "empty_record"),
    ("   ", "empty_record"),
    ("[1, 2]", "malformed_json"),
    ("null", "malformed_json"),
    ('{"eventTime":1,' + BASE + ',"extra":1}', "unknown_property"),
    ('{"eventTime":1,' + BASE.replace('"productId"', '"productid"') + '}', "unknown_property"),
    ('{' + BASE + '}', "missing_event_time"),
    ('{"eventTime":1,' + BASE.replace('"eventType":"view",', '') + '}', "missing_event_type"),
    ('{"eventTime":1,' + BASE.replace('"view"', '"remove"') + '}', "unknown_event_type"),
    ('{"eventTime":1,' + BASE.replace('"productId":1', '"productId":"7"') + '}', "malformed_json"),
    ('{"eventTime":1,' + BASE.replace('"productId":1', '"productId":1.5') + '}', "malformed_json"),
])
def test_reject_cases(spark, value, reason):
    (r,) = _decode(spark, [value], lenient=False).collect()
    assert r.reject_reason == reason


@pytest.mark.parametrize("time_text,ok", [
    ("2019-10-01T00:00:00Z", True), ("2019-10-01T02:00:00+02:00", True), ("2019-10-01T00:00:00", False),
    ("2019-10-01", False), ("2019-10-01 00:00:00", False)])
def test_text_times_name_their_zone(spark, time_text, ok):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        (r,) = _decode(spark, ['{"eventTime":"' + time_text + '",' + BASE + '}']).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.reject_reason, r.event_time) == ((None, dt.datetime(2019, 10, 1)) if ok else ("malformed_json", None))


def test_lax_mode_ignores_unknown_property(spark):
    (r,) = _decode(spark, ['{"eventTime":1,' + BASE + ',"extra":1}'], strict=False).collect()
    assert r.reject_reason is None


def test_missing_long_binds_zero(spark):
    (r,) = _decode(spark, ['{"eventTime":1,' + BASE.replace('"productId":1,', '') + '}']).collect()
    assert r.reject_reason is None and r.product_id == 0


def test_price_as_text_and_trailing_text(spark):
    out = _decode(spark, ['{"eventTime":1,' + BASE.replace('99.90', '"3.5"') + '}',
                          '{"eventTime":1,' + BASE + '} trailing']).collect()
    assert [r.reject_reason for r in out] == [None, None]
    assert out[0].price == Decimal("3.5")


def test_encode_format(spark):
    ev = spark.createDataFrame([(dt.datetime(2019, 10, 1, 0, 0, 0, 250000), "view", 1, 2053013552326770905,
                                 "electronics.smartphone", None, Decimal("99.90"), 1, "s-1")], EVENT_SCHEMA)
    (text,) = ev.select(encode_event().alias("v")).first()
    assert text.startswith('{"eventTime":1569888000.250000000,"eventType":"view","productId":1,'
                           '"categoryId":2053013552326770905,"categoryCode":"electronics.smartphone",'
                           '"brand":null,"price":99.9')
    assert text.endswith('"userId":1,"userSession":"s-1"}')


def test_round_trip(spark):
    data = [
        (dt.datetime(2024, 1, 1, 0, 0, 7, 179575), "view", 1, 2053013552326770905, None, "b",
         Decimal("1.23456"), 9, "s"),
        (dt.datetime(1999, 12, 31, 23, 59, 59, 999999), "purchase", -5, 9223372036854775807, "",
         None, Decimal("0"), 0, None),
        (dt.datetime(2030, 6, 1, 12, 0, 0), "cart", 0, 1, 'quo"te\nnl', "\t", Decimal("-12.5"), 3, ""),
    ]
    ev = spark.createDataFrame(data, EVENT_SCHEMA)
    back = split(decode_events(ev.select(encode_event().alias("value")))).good
    key = lambda r: r[0]
    assert sorted([tuple(r) for r in back.select(*EVENT_COLUMNS).collect()], key=key) == sorted(data, key=key)


def test_decode_is_zone_independent(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        (r,) = _decode(spark, ['{"eventTime":1569888000.5,' + BASE + '}']).collect()
        assert r.event_time == dt.datetime(2019, 10, 1, 0, 0, 0, 500000)
        ev = spark.createDataFrame([(r.event_time,)], "event_time timestamp_ntz")
        (text,) = ev.select(F.to_json(F.struct("event_time")).alias("x")).first()
        assert "2019-10-01T00:00:00.5" in text
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


@pytest.mark.parametrize("text,expected", [
    ('"7"', 7), ("1.5", 1), ("-1.9", -1), ("1e3", 1000), ("7", 7), ("null", 0),
])
def test_lenient_numbers_bind(spark, text, expected):
    value = '{"eventTime":1,' + BASE.replace('"productId":1', '"productId":' + text) + '}'
    df = spark.createDataFrame([(value,)], "value string")
    (r,) = decode_events(df).collect()
    assert r.reject_reason is None and r.product_id == expected


@pytest.mark.parametrize("text", ['"abc"', "true", "99999999999999999999", '"1 "'])
def test_lenient_numbers_still_reject_non_numbers(spark, text):
    value = '{"eventTime":1,' + BASE.replace('"productId":1', '"productId":' + text) + '}'
    df = spark.createDataFrame([(value,)], "value string")
    (r,) = decode_events(df).collect()
    assert r.reject_reason == "bad_number"
