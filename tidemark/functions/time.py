"""Event-time conversions.

Events carry ``event_time`` as TIMESTAMP_NTZ holding UTC wall-clock time.
Watermarks need an instant (TIMESTAMP), so the two are converted with
microsecond arithmetic against the epoch, never through the session time
zone: results are the same whatever ``spark.sql.session.timeZone`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import CSV_TIME_SUFFIX_LEN

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _epoch() -> Column:
    return F.expr(_EPOCH_NTZ)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wallclock_micros(ntz) -> Column:
    """Microseconds since the epoch of a UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ntz))


def from_micros(micros) -> Column:
    """Microseconds since the epoch -> UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(micros), _epoch())


def to_instant(ntz) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> TIMESTAMP instant."""
    return F.timestamp_micros(wallclock_micros(ntz))


def to_wallclock(ts) -> Column:
    """TIMESTAMP instant -> UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), _epoch())


def epoch_seconds(ntz) -> Column:
    """Seconds since the epoch with a 9-digit fraction, DECIMAL(20,9).

    This is the JSON wire form of an instant (``1569888000.250000000``).
    Computed in decimal so no digit is lost to a double.
    """
    micros = wallclock_micros(ntz).cast("decimal(26,0)")
    return (micros / F.lit(1000000)).cast("decimal(20,9)")


def from_epoch_seconds(seconds) -> Column:
    """DECIMAL seconds since the epoch -> UTC wall-clock TIMESTAMP_NTZ (floor to µs)."""
    micros = F.floor(_c(seconds) * F.lit(1000000)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, _epoch())


# --- Fixed value: the CSV event-time layout, with every digit as 0.
CSV_TIME_LAYOUT = "0000-00-00 00:00:00"
# --- end of fixed values.


def _clamped(body: Column) -> Column:
    """A time in the layout whose date is none: a day past the month's end becomes its last day, else NULL."""
    first, day = F.concat(F.substring(body, 1, 8), F.lit("01")), F.substring(body, 9, 2)
    last = F.last_day(first.try_cast("date"))
    moved = F.concat(last.cast("string"), F.substring(body, 11, 9)).try_cast("timestamp_ntz")
    return F.when(day.between("29", "31"), moved)


def parse_utc_text(text, clamp_days: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss<4-char zone>`` -> TIMESTAMP_NTZ, NULL when unparsable.

    The last four characters are cut unchecked (any suffix is accepted) and
    the rest, whose places are fixed, is read as UTC. A day past the month's end, such as 02-30, is its
    last day (as the default resolver has it), or NULL without ``clamp_days``.
    """
    t = _c(text)
    body = F.substring(t, 1, len(CSV_TIME_LAYOUT))
    laid_out = ((F.length(t) == len(CSV_TIME_LAYOUT) + CSV_TIME_SUFFIX_LEN)
                & (F.translate(body, "123456789", "000000000") == CSV_TIME_LAYOUT))
    read = body.try_cast("timestamp_ntz")
    return F.when(laid_out, F.coalesce(read, _clamped(body)) if clamp_days else read)


def text_utc(ntz) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> ``yyyy-MM-dd HH:mm:ss`` text.

    Uses the NTZ string form (zone-free) instead of ``date_format``, which
    would pass through the session zone and shift times in DST gaps.
    """
    return F.substring(_c(ntz).cast("string"), 1, 19)
