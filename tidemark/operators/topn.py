"""Top-N categories per window.

Counting is distributed (see ``windows``); only the small per-(window,
category) counts reach the ranking, which Spark plans as a partial
``WindowGroupLimit`` before the exchange on the window, so at most N rows
per window leave each task however many categories a window holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import category_counts
from tidemark.schema import TOP_N, UNKNOWN_CATEGORY, WINDOW


def top_n_per_window(counts: DataFrame, n: int = TOP_N, key: str = "category_code") -> DataFrame:
    """Rank ``key`` within each window by ``event_count`` descending; keep ranks 1..n.

    Ranks are consecutive and never shared (``row_number``): equal counts are
    ordered by ``key`` ascending, which fixes which key falls off at rank n.
    """
    order = Window.partitionBy("window_start").orderBy(F.desc("event_count"), F.asc(key))
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n).select(
        "window_start", "window_end", F.col("rank").cast("int").alias("rank"), key, "event_count")


def category_top_n(events: DataFrame, length: str = WINDOW, n: int = TOP_N,
                   fallback: str = UNKNOWN_CATEGORY) -> DataFrame:
    """The n categories with most events (all types together) in each window."""
    return top_n_per_window(category_counts(events, length, fallback=fallback), n)
