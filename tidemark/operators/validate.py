"""Validity rules and the good / reject split (one policy for every source).

Each source computes a ``reject_reason`` column: NULL for a valid event,
else the first rule the record breaks. ``on_error`` chooses what happens
to rejects: ``"reject"`` keeps them in a frame of their own, ``"fail"``
stops the job on the first one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.scalar import is_known_type
from tidemark.schema import EVENT_COLUMNS

REASON = "reject_reason"
# Columns an event cannot do without, in the order they are checked.
REQUIRED = ("event_time", "event_type", "product_id", "category_id", "price", "user_id")


class Split(NamedTuple):
    good: DataFrame
    rejects: DataFrame


def first_reason(checks: Iterable[tuple[Column, str]]) -> Column:
    """The label of the first true check, NULL when none holds."""
    expr = None
    for cond, label in checks:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")


def typed_checks(field: Callable[[str], Column] = F.col,
                 required: tuple[str, ...] = REQUIRED) -> list[tuple[Column, str]]:
    """Checks on typed event columns: required fields present, type known."""
    checks = []
    for name in required:
        checks.append((field(name).isNull(), f"missing_{name}"))
        if name == "event_type":
            checks.append((~is_known_type(field(name)), "unknown_event_type"))
    return checks


def with_reject_reason(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Typed events (e.g. a table) -> same rows with ``reject_reason``."""
    return df.withColumn(REASON, first_reason(typed_checks(required=required)))


def good_events(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """The valid rows of typed events, by plain conditions that a scan can take over."""
    for name in required:
        df = df.filter(F.col(name).isNotNull())
        if name == "event_type":
            df = df.filter(is_known_type(F.col(name)))
    return df


def split(df: DataFrame, on_error: str = "reject", keep: tuple[str, ...] = ()) -> Split:
    """Split a frame carrying ``reject_reason`` into canonical good rows and rejects.

    Both halves are lazy views of the same input: to materialise both in one
    pass over a large input, use :func:`write_split` instead.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError(f"on_error must be 'reject' or 'fail', not {on_error!r}")
    reason = F.col(REASON)
    if on_error == "fail":
        guard = F.when(reason.isNotNull(),
                       F.raise_error(F.concat(F.lit("invalid event: "), reason)))
        df = df.withColumn(REASON, F.coalesce(guard.cast("string"), reason))
    good = df.filter(reason.isNull()).select(*EVENT_COLUMNS, *keep)
    rejects = df.filter(reason.isNotNull())
    return Split(good, rejects)


class InvalidEvent(ValueError):
    """A run that stops on bad records has met its first one."""


def until_first_error(checked: DataFrame, position: str = "position") -> tuple[DataFrame, Row | None]:
    """The good events before the first reject in order of ``position``, and that reject (None without one).

    What a reader does that takes records one by one and stops at the first it cannot bind: the events before it
    are done. The first reject is one aggregate over the rejects; one row comes to the driver.
    """
    bad = checked.where(F.col(REASON).isNotNull()).agg(F.min(F.struct(position, REASON)).alias("first")).first()["first"]
    good = checked.where(F.col(REASON).isNull())
    if bad is not None:
        at = bad[position]
        place = F.struct(*[F.lit(v).alias(n) for n, v in at.asDict().items()]) if isinstance(at, Row) else F.lit(at)
        good = good.where(F.col(position) < place.cast(checked.schema[position].dataType))
    return good, bad


def write_split(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """One pass, both outcomes: a table partitioned by ``outcome`` (good / rejected).

    Readers select a side with a partition filter, which prunes the other
    side's files, so nothing is scanned or decoded twice.
    """
    outcome = F.when(F.col(REASON).isNull(), F.lit("good")).otherwise(F.lit("rejected"))
    df.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").format(fmt).save(path)
