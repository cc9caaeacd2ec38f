"""Evaluate columns exactly once, behind a Generate.

The optimizer pushes filters through projections by inlining the projected
expressions, and prunes file scans down to the columns a query references.
Both are right for cheap pure columns and wrong for two things here: an
expensive parse (the inlined copy runs again inside the filter) and a CSV
record whose validity depends on seeing every field (a pruned CSV parse
never reports a wrong field count). ``inline(array(struct(...)))`` emits the
same row once; filters on its output cannot move below it, and its input
columns are always required.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, keep: list[str] | tuple[str, ...] = (), **named: Column) -> DataFrame:
    """``keep`` columns passed through, ``named`` columns evaluated once per row."""
    packed = F.struct(*[c.alias(n) for n, c in named.items()])
    return df.select(*keep, F.inline(F.array(packed)))
