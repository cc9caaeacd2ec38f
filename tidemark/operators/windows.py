"""Counts per tumbling event-time window (batch and streaming).

``groupBy(window, key).count()`` plans as partial aggregation on every
input partition, an exchange on (window, key) of at most one row per group
per partition, then the final merge: a hot key or a hot window costs one
row per map task, never a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import category_or_unknown, type_name
from tidemark.functions.time import to_wallclock
from tidemark.schema import UNKNOWN_CATEGORY, WINDOW


def windowed_counts(df: DataFrame, keys: dict[str, Column], length: str = WINDOW,
                    time_col: str = "event_time") -> DataFrame:
    """``window_start, window_end, <keys...>, event_count`` per tumbling window.

    ``time_col`` may be the UTC wall-clock NTZ column (batch) or a TIMESTAMP
    instant carrying a watermark (streaming); bounds come out as NTZ either
    way. Windows are epoch-aligned ``[start, end)``; a key with no events in
    a window yields no row.
    """
    w = F.window(time_col, length)
    counted = df.groupBy(w.alias("w"), *[c.alias(n) for n, c in keys.items()]).agg(
        F.count(F.lit(1)).alias("event_count"))
    start, end = F.col("w.start"), F.col("w.end")
    if isinstance(df.schema[time_col].dataType, T.TimestampType):
        start, end = to_wallclock(start), to_wallclock(end)
    return counted.select(start.alias("window_start"), end.alias("window_end"),
                          *keys.keys(), "event_count")


def event_type_counts(events: DataFrame, length: str = WINDOW,
                      time_col: str = "event_time") -> DataFrame:
    """Events per (window, event type); the type is reported by constant name (``VIEW``)."""
    return windowed_counts(events, {"event_type": type_name("event_type")}, length, time_col)


def category_counts(events: DataFrame, length: str = WINDOW, time_col: str = "event_time",
                    fallback: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Events of all types per (window, category); NULL category counts as ``fallback``."""
    return windowed_counts(events, {"category_code": category_or_unknown("category_code", fallback)},
                           length, time_col)
