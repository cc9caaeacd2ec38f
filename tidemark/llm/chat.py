"""Chat formatting by multi-party perspective rotation.

Every participant of a conversation gets a rendering of the whole dialogue in
which that speaker is the assistant and all others are named users. The result
is one row per (conversation, perspective, turn) with the rendered segment, its
place in the rendered dialogue and whether a model learns from it, so a
dialogue of any length is spread over many rows and tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import settle

# Fixed values of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"

FIRST = 256  # characters by which turns of one number and speaker are ordered


def _plain(c: Column) -> Column:
    """Text that cannot be read as a turn mark: the bar of ``<|`` gets a space before it."""
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame) -> DataFrame:
    """``conv_id, perspective, position, speaker, chat_role, header, body, segment, start, stop, learn``.

    ``turns`` has ``conv_id, turn, role, text``. Speakers are the distinct roles
    of a conversation but the system, which is context: it takes no
    perspective and is rendered as ``system`` in all of them. ``start`` and
    ``stop`` are character offsets of the segment in the rendered dialogue;
    ``learn`` is true for the perspective's own turns, whose ``body`` and closing
    mark are to be learnt, never the header.

    Turns are ordered by (turn, role, first 256 characters of the text), those that are alike in all of
    these by a hash of the text; a null turn comes first, a null
    role is the speaker ``unknown``, null text is empty. Repeated rows are turns
    of their own. A conversation of system turns alone has no perspective and
    gives no rows, and so does an empty table; null ``conv_id`` is a conversation of
    its own; other columns are not read.

    Offsets come from sums within range partitions of (conv_id, turn), moved up
    by the sums of earlier partitions: a conversation with a third of all
    turns is split among tasks like any other.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("body"))
    said = said.select("*", F.substring("body", 1, FIRST).alias("first"), F.xxhash64("body").alias("tie"),
                       F.monotonically_increasing_id().alias("seq"))
    by = ["conv_id", "turn", "speaker", "first", "tie", "seq"]
    ranged = settle(said.repartitionByRange(*by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("split")), "turns")

    speakers = ranged.where(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = ranged.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when(role == "user", F.concat(F.lit(" name="), _plain(F.col("speaker")))).otherwise("")
    header = F.concat(F.lit(OPEN), role, name, F.lit("\n"))
    seen = seen.select("conv_id", "perspective", "split", "turn", "speaker", "first", "tie", "seq", role.alias("chat_role"),
                       header.alias("header"), _plain(F.col("body")).alias("body"), own.alias("learn"))
    seen = seen.withColumn("segment", F.concat("header", "body", F.lit(CLOSE + "\n"))).withColumn(
        "chars", F.char_length("segment").cast("long"))

    parts = seen.groupBy("conv_id", "perspective", "split").agg(F.sum("chars").alias("sum"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(
        F.col("conv_id").alias("of"), F.col("perspective").alias("by"), F.col("split").alias("at"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_before"))
    here = Window.partitionBy("conv_id", "perspective", "split").orderBy("turn", "speaker", "first", "tie", "seq")
    placed = seen.select(
        "*", F.sum("chars").over(here.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.row_number().over(here).alias("rank"))
    placed = placed.join(carry, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("perspective") == F.col("by"))
                         & (F.col("split") == F.col("at")))
    return placed.select(
        "conv_id", "perspective", (F.col("turns_before") + F.col("rank") - 1).cast("long").alias("position"),
        "speaker", "chat_role", "header", "body", "segment",
        (F.col("before") + F.col("upto") - F.col("chars")).cast("long").alias("start"),
        (F.col("before") + F.col("upto")).cast("long").alias("stop"), "learn")


ORACLE = r"""
with said as (
  select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as tie,
         replace(coalesce(text, ''), '<|', '< |') as body
  from conversations),
speakers as (select distinct conv_id, speaker as perspective from said where speaker <> 'system'),
seen as (
  select s.conv_id, p.perspective, s.turn, s.speaker, s.tie, s.body,
         case when s.speaker = 'system' then 'system' when s.speaker = p.perspective then 'assistant' else 'user' end as chat_role
  from said s join speakers p on s.conv_id is not distinct from p.conv_id),
rendered as (
  select *, '<|im_start|>' || chat_role
            || case when chat_role = 'user' then ' name=' || replace(speaker, '<|', '< |') else '' end || chr(10) as header
  from seen),
whole as (select *, header || body || '<|im_end|>' || chr(10) as segment from rendered),
summed as (
  select *, cast(sum(length(segment)) over w as bigint) as stop, row_number() over w - 1 as position
  from whole window w as (partition by conv_id, perspective order by turn nulls first, speaker, substr(tie, 1, 256), tie
                          rows between unbounded preceding and current row))
select conv_id, perspective, position, speaker, chat_role, header, body, segment,
       stop - length(segment) as start, stop, chat_role = 'assistant' as learn
from summed
"""
