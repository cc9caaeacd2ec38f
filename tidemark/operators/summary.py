"""Ingest totals, preview and the text renderings of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.time import text_utc
from tidemark.operators.validate import REASON
from tidemark.schema import PREVIEW_ROWS, PROGRESS_EVERY


def ingest_summary(validated: DataFrame) -> DataFrame:
    """One row: records read, accepted and rejected (a global partial+final aggregate)."""
    bad = F.col(REASON).isNotNull()
    return validated.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~bad).alias("good_records"),
        F.count_if(bad).alias("rejected_records"),
    )


def observe_ingest(validated: DataFrame, name="ingest") -> DataFrame:
    """Same totals as metrics on a running (batch or streaming) plan, no extra pass.

    ``name`` is a metric name (streaming: read ``lastProgress.observedMetrics``)
    or a ``pyspark.sql.Observation`` (batch: read ``Observation.get``).
    """
    bad = F.col(REASON).isNotNull()
    return validated.observe(name, F.count(F.lit(1)).alias("total_records"),
                             F.count_if(~bad).alias("good_records"),
                             F.count_if(bad).alias("rejected_records"))


def progress_marks(events: DataFrame, every: int = PROGRESS_EVERY) -> DataFrame:
    """Every ``every``-th event, in the order of its files, with ``sent``, the number of events up to it.

    ``events`` are rows of a file scan with ``file`` and ``block`` (split). Rows of a split are numbered as they
    are read, without a shuffle, and moved up by the rows of earlier splits: one number for each split.
    """
    numbered = events.withColumn("_row", F.monotonically_increasing_id())
    whole = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each split
    splits = numbered.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")).select(
        "file", "block", "_first", F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_before"))
    sent = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return numbered.join(splits, ["file", "block"]).withColumn("sent", sent).where(F.col("sent") % every == 0).drop(
        "_row", "_first", "_before", "file", "block")


def preview(events: DataFrame, n: int = PREVIEW_ROWS,
            order_by: tuple[str, ...] = ("event_time",)) -> DataFrame:
    """The first n events in order (of ``position``: as they stand in their files): a per-partition top-n, then one merge of n rows each."""
    return events.orderBy(*order_by).limit(n)


def _bounds():
    return text_utc("window_start"), text_utc("window_end")


def event_type_count_lines(counts: DataFrame) -> DataFrame:
    """``[start - end] TYPE: n`` per count row (times UTC)."""
    start, end = _bounds()
    return counts.select(F.format_string("[%s - %s] %s: %d", start, end,
                                         F.col("event_type"), F.col("event_count")).alias("line"))


def category_top_n_lines(top: DataFrame) -> DataFrame:
    """``[start - end] #rank category: n`` per ranked row (times UTC)."""
    start, end = _bounds()
    return top.select(F.format_string("[%s - %s] #%d %s: %d", start, end, F.col("rank"),
                                      F.col("category_code"), F.col("event_count")).alias("line"))
