"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary file ``name`` is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


WORD = re.compile(r"\w+")
NOT_WORD = re.compile(r"\W")
PIECE = 4 << 20  # characters read into words at a time


def words(text: str | None):
    """Lists of the words of the whole text in lower case, some MB of text at a time."""
    text = (text or "").lower()
    at = 0
    while at < len(text):
        end = NOT_WORD.search(text, min(at + PIECE, len(text)))
        stop = end.start() if end else len(text)
        yield WORD.findall(text, at, stop)
        at = max(stop, at + 1)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder the cluster shares and read it back.

    Cuts lineage: what follows reads files that outlive any executor, and the
    rows (also of non-deterministic expressions) stay the same on every read.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id's text, modulo 4, is 2."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Columns that identify a row by its id and text; none of them is null.
KEY = ["id_null", "id", "content"]


def keyed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """``KEY`` columns of ``docs`` (integer ``doc_id``, ``text``) and ``more``, without name clashes.

    Rows that repeat an id and its text share a key; a null id is kept apart from
    every other; the hash of the text parts different texts of one id.
    """
    return docs.select(F.col("doc_id").isNull().alias("id_null"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
                       F.xxhash64("text").alias("content"), *more)


def numbered(columns: list[str]) -> list[Column]:
    """Columns under names that clash with nothing, ``__0, __1, ...``, to carry along and name again at the end."""
    return [F.col("`" + c.replace("`", "``") + "`").alias(f"__{i}") for i, c in enumerate(columns)]


def doc_id_of() -> Column:
    """The ``doc_id`` that a key was made of."""
    return F.when(~F.col("id_null"), F.col("id"))


def share_of(draw: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1."""
    return F.shiftrightunsigned(draw, 11).cast("double") * (2.0 ** -53)


def share_that_holds(most: Column | int, rows: Column | int) -> Column:
    """A share of ``rows`` uniform draws that holds the ``most`` smallest, but for a negligible chance."""
    most, rows = (F.lit(v) if isinstance(v, int) else v for v in (most, rows))
    return (4.0 * most + 100) / F.greatest(rows, F.lit(1))


def smallest(rows: DataFrame, draw: Column, most: int, *ties: str) -> DataFrame:
    """The ``most`` rows of smallest hash. Larger hashes are put aside in each task, so that few rows meet in one."""
    near = rows.where(share_of(draw) <= share_that_holds(most, rows.count()))
    return near.orderBy(draw, *ties).limit(most)


def slices(texts, most: int = 4 << 20):
    """(from, to) ranges of rows that hold about ``most`` bytes of text, at least a row."""
    at = size = 0
    for i in range(len(texts)):
        size += len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def places(rows: DataFrame, group: list[str], order: list[str], name: str, parts: int) -> DataFrame:
    """``rows`` with ``place``, counted from 0 in ``order`` (ascending, nulls first) within each group, ``of``, the rows
    of the group, and ``split``, a range partition of (group, order).

    Rows are counted within (group, range partition) and moved up by the rows of earlier
    partitions, so a group with a third of all rows is counted by many tasks. Group columns hold
    no nulls; rows equal in all columns of ``order`` take places in any order.
    """
    by = [*group, *order]
    ranged = settle(rows.repartitionByRange(parts, *by).select("*", F.spark_partition_id().alias("split")), name)
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*group, "split").agg(F.count("*").alias("n")).select(
        *group, "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("of"))
    here = F.row_number().over(Window.partitionBy(*group, "split").orderBy(*order)) - 1
    return ranged.withColumn("here", here).join(starts, [*group, "split"]).select(
        *rows.columns, (F.col("before") + F.col("here")).alias("place"), "of", "split")


def parts_for(rows: DataFrame, most: int) -> int:
    """Partitions of about ``most`` rows, no fewer than the session's shuffle partitions."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // most))
