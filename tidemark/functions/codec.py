"""JSON wire codec of events.

Wire form: one JSON object per event, camelCase property names, the event
time as a number of seconds with a 9-digit fraction, nulls written out.
Decoding tolerates the other two time encodings readers accept (integer
seconds, ISO-8601 text) and flags every record it cannot bind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fence import fence
from tidemark.functions.scalar import DECIMAL_TEXT, LONG_TEXT
from tidemark.functions.time import epoch_seconds, from_epoch_seconds, to_wallclock
from tidemark.operators.validate import first_reason, typed_checks
from tidemark.schema import CORRUPT_COLUMN, EVENT_COLUMNS, PRICE_TYPE, WIRE_NAMES, WIRE_OF

_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
_LONG_FIELDS = ("product_id", "category_id", "user_id")


def _wire_schema(time_type: T.DataType, long_type: T.DataType = T.LongType()) -> T.StructType:
    types = {
        "eventTime": time_type, "eventType": T.StringType(), "productId": long_type,
        "categoryId": long_type, "categoryCode": T.StringType(), "brand": T.StringType(),
        "price": PRICE_TYPE, "userId": long_type, "userSession": T.StringType(),
    }
    fields = [T.StructField(n, types[n], True) for n in WIRE_NAMES]
    return T.StructType(fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


# Pass 1 reads the time as decimal seconds (the wire form, also integer
# seconds). Only records pass 1 cannot bind are parsed again with the time as
# a TIMESTAMP (ISO text); a record that fails both is malformed.
_PASS_DECIMAL = _wire_schema(T.DecimalType(20, 9))
_PASS_TIMESTAMP = _wire_schema(T.TimestampType())
# Lenient binding reads the integer fields as text and converts them itself.
_LENIENT_DECIMAL = _wire_schema(T.DecimalType(20, 9), T.StringType())
_LENIENT_TIMESTAMP = _wire_schema(T.TimestampType(), T.StringType())

# An instant as text: a date, a time, and the zone it is in.
ZONED_TIME = r"^[+-]?[0-9]+-[0-9]{2}-[0-9]{2}[Tt][0-9:.,]+([Zz]|[+-][0-9]{2}(:?[0-9]{2}){0,2})$"


def lenient_long(text: Column) -> Column:
    """Integer text as is; a fractional number truncated toward zero; else NULL."""
    return (F.when(text.rlike(LONG_TEXT), text.try_cast("bigint"))
            .when(text.rlike(DECIMAL_TEXT), text.try_cast(PRICE_TYPE).try_cast("bigint")))


def encode_event() -> Column:
    """Canonical event columns -> JSON text (nulls kept, time as decimal seconds)."""
    fields = []
    for name in EVENT_COLUMNS:
        col = epoch_seconds(name) if name == "event_time" else F.col(name)
        fields.append(col.alias(WIRE_OF[name]))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _bound(parsed: Column, time_col: Column, lenient: bool = False) -> Column:
    """A canonical-event struct from one parse pass (plus the unconvertible integer fields)."""
    fields = [time_col.alias("event_time")]
    bad = []
    for name in EVENT_COLUMNS[1:]:
        value = parsed.getField(WIRE_OF[name])
        if name in _LONG_FIELDS:
            if lenient:
                text, value = value, lenient_long(value)
                bad.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"bad_{name}")))
            value = F.coalesce(value, F.lit(0).cast("bigint"))  # missing or null longs bind as 0
        fields.append(value.alias(name))
    fields.append(F.coalesce(*bad, F.lit(None).cast("string")).alias("_bad") if bad
                  else F.lit(None).cast("string").alias("_bad"))
    return F.struct(*fields)


def decode_events(df: DataFrame, value_col: str = "value", strict: bool = True,
                  keep: tuple[str, ...] = (), lenient_numbers: bool = True) -> DataFrame:
    """JSON text -> canonical events plus ``reject_reason`` (NULL when valid).

    ``strict`` rejects records carrying properties outside the event model,
    as a default JSON binder does; it reads the property names in a pass of its
    own. ``lenient_numbers`` (the default, as that binder has it) binds quoted
    integers (``"7"``) and truncates fractional ones (``1.5`` -> 1) for the integer
    fields; without it both reject the record. A time as text must name its
    zone (``Z`` or an offset). ``keep`` lists input columns carried through (record
    coordinates, the raw value). The values are parsed once (twice only when
    the time is text), however the result is used.
    """
    v = F.col(value_col)
    carry = list(dict.fromkeys([*keep, value_col]))
    pass_decimal, pass_timestamp = ((_LENIENT_DECIMAL, _LENIENT_TIMESTAMP) if lenient_numbers
                                    else (_PASS_DECIMAL, _PASS_TIMESTAMP))
    first = {"_p1": F.from_json(v, pass_decimal, _JSON_OPTS)}
    if strict:
        unknown = F.array_except(F.json_object_keys(v), F.array(*[F.lit(n) for n in WIRE_NAMES]))
        first["_unknown"] = F.size(unknown) > 0
    staged = fence(df, carry, **first)
    p1 = F.col("_p1")
    p1_ok = p1.getField(CORRUPT_COLUMN).isNull()
    zoned = F.get_json_object(v, "$." + WIRE_OF["event_time"]).rlike(ZONED_TIME)
    staged = fence(staged, [*carry, *first],
                   _p2=F.when(~p1_ok, F.when(zoned, F.from_json(v, pass_timestamp, _JSON_OPTS))))
    p2 = F.col("_p2")
    event = (F.when(p1_ok, _bound(p1, from_epoch_seconds(p1.getField("eventTime")), lenient_numbers))
             .when(p2.isNotNull() & p2.getField(CORRUPT_COLUMN).isNull(),
                   _bound(p2, to_wallclock(p2.getField("eventTime")), lenient_numbers)))
    staged = staged.select(*carry, *[c for c in first if c != "_p1"], event.alias("_event"))

    ev = F.col("_event")
    checks = [
        (v.isNull() | (F.trim(v) == ""), "empty_record"),
        (ev.isNull(), "malformed_json"),
    ]
    if strict:
        checks.append((F.col("_unknown"), "unknown_property"))
    if lenient_numbers:
        checks.append((ev.getField("_bad").isNotNull(), "bad_number"))
    checks += typed_checks(lambda n: ev.getField(n), required=("event_time", "event_type"))
    # The reason is fenced too: the reject split then filters on a plain column
    # instead of re-deriving the event and its checks inside the filter.
    staged = fence(staged, list(keep), _event=ev, reject_reason=first_reason(checks))
    return staged.select(*keep, *[ev.getField(n).alias(n) for n in EVENT_COLUMNS], "reject_reason")
