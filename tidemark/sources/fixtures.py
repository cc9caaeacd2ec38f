"""Adapters from the driver's tables to this model's inputs.

The driver's ``events`` table has no category, product or price; they are
derived from its ``props`` number ``k``, deterministically, so the same
rows can be rebuilt in SQL for an independent oracle (``EVENTS_SQL``).
``click`` plays the cart event; ``signup`` and ``error`` stay unknown types
and exercise the reject path. ``orders`` gives a change feed: every order
is inserted, then, by key, updated, deleted, or deleted and re-inserted.

Everything here is a projection (plus one ``inline`` for the change rows):
no shuffle, work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codec import encode_event
from tidemark.functions.scalar import user_key
from tidemark.functions.time import text_utc, wallclock_micros
from tidemark.schema import EVENT_COLUMNS, TOPIC_PARTITIONS

CATEGORY_ID_BASE = 2053013552326770000  # beyond 2^53: ids must never pass through a double


# Declared schemas of the driver tables used here: no footer reads to infer them.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; splits follow ``spark.sql.files.maxPartitionBytes`` and its row groups."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, position: bool = False, split: bool = False) -> DataFrame:
    """``event_id`` + the nine canonical columns (event types not yet validated); each row's ``position`` in the files, or its split (``file, block``)."""
    e = table(spark, sf_dir, "events")
    place = [F.struct("_metadata.file_path", "_metadata.row_index").alias("position")] if position else []
    place += [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")] if split else []
    k = F.regexp_extract("props", r"([0-9]+)", 1).try_cast("bigint")
    return e.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart")).otherwise(F.col("event_type")).alias("event_type"),
        k.alias("product_id"),
        (F.lit(CATEGORY_ID_BASE) + k % 20).alias("category_id"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("cat."), (k % 20).cast("string"))).alias("category_code"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("brand-"), (k % 7).cast("string"))).alias("brand"),
        F.col("value").cast("decimal(12,2)").cast("decimal(38,18)").alias("price"),
        "user_id",
        F.concat(F.lit("session-"), F.col("user_id").cast("string")).alias("user_session"),
        *place,
    )


# The same adapter in SQL that DuckDB (and Spark) run; used by the oracles.
EVENTS_SQL = f"""
select event_id,
       ts as event_time,
       case event_type when 'click' then 'cart' else event_type end as event_type,
       k as product_id,
       {CATEGORY_ID_BASE} + k % 20 as category_id,
       case when k % 10 = 0 then null else 'cat.' || cast(k % 20 as varchar) end as category_code,
       case when k % 7 = 0 then null else 'brand-' || cast(k % 7 as varchar) end as brand,
       cast(cast(value as decimal(12,2)) as decimal(38,18)) as price,
       user_id,
       'session-' || cast(user_id as varchar) as user_session
from (select *, try_cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events) e0
"""


def topic_records(events: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Events as topic records: key = user id text, value = event JSON.

    ``offset`` is the event id (unique, increasing in time), ``partition`` a
    function of the key, as a keyed producer would place it.
    """
    return events.select(
        (F.col("user_id") % partitions).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        user_key("user_id").alias("key"),
        encode_event().alias("value"),
    )


def write_in_order(rows: DataFrame, order: Column, slices: int, files: int, write: Callable[[DataFrame], None], staging: str) -> None:
    """Hand ``rows`` to ``write`` slice by slice in ascending ``order`` (a number; nulls first), each as ``files`` equal files.

    A file stream reads files by the time they were written, and the files of one write are closed in any order. So
    slices are written one after another, and a reader takes ``files`` at a time: a slice to a micro-batch (as long as a slice
    has that many rows). The rows are dealt into slices once, by quantiles of ``order``, under ``staging``.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("__order", order.cast("double"))
    bounds = placed.approxQuantile("__order", [i / slices for i in range(1, slices)], 0.001) or []
    number = F.lit(0)
    for bound in bounds:
        number = number + F.coalesce((F.col("__order") > bound).cast("int"), F.lit(0))
    placed.withColumn("__slice", number).write.mode("overwrite").partitionBy("__slice").parquet(staging)
    staged = spark.read.schema(placed.schema.add("__slice", "integer")).parquet(staging)
    for i in range(slices):
        part = staged.where(F.col("__slice") == i).repartition(files).sortWithinPartitions("__order")
        write(part.drop("__order", "__slice"))


def in_order(events: DataFrame, path: str, slices: int, files: int, write: Callable[[DataFrame], None]) -> None:
    """`write_in_order` of events by their time."""
    write_in_order(events, wallclock_micros("event_time"), slices, files, write, f"{path}-slices")


def write_topic_files(records: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> str:
    """Envelope files (one directory = one replayable topic), JSON lines or parquet."""
    records.write.mode(mode).format(fmt).save(path)
    return path


def binding_cases(records: DataFrame) -> DataFrame:
    """Topic records whose JSON is written another way, by offset % 6.

    1: product id as text; 2: user id with a fraction; 3: no product id; 4: time as
    text in UTC, to the second; 5: time as text without a zone; 0: as it was.
    """
    kind = F.col("offset") % 6
    value = F.col("value")
    seconds = F.regexp_extract(value, r'"eventTime":([0-9]+)', 1).cast("bigint")
    text = F.substring(F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("string"), 1, 19)
    iso = F.replace(text, F.lit(" "), F.lit("T"))

    def with_time(form):
        return F.concat(F.lit('{"eventTime":"'), form, F.lit('",'), F.regexp_extract(value, r'^[{]"eventTime":[^,]*,(.*)$', 1))

    return records.withColumn("value", F.when(kind == 1, F.regexp_replace(value, r'"productId":([0-9]+)', '"productId":"$1"'))
                              .when(kind == 2, F.regexp_replace(value, r'"userId":([0-9]+)', '"userId":$1.75'))
                              .when(kind == 3, F.regexp_replace(value, r'"productId":[^,]*,', ""))
                              .when(kind == 4, with_time(F.concat(iso, F.lit("Z"))))
                              .when(kind == 5, with_time(iso)).otherwise(value))


def csv_text_columns(events: DataFrame) -> DataFrame:
    """Canonical events rendered as the nine CSV text columns."""
    cols = []
    for name in EVENT_COLUMNS:
        if name == "event_time":
            cols.append(F.concat(text_utc(name), F.lit(" UTC")).alias(name))
        else:
            cols.append(F.col(name).cast("string").alias(name))
    return events.select(*cols)


def with_line_breaks(events: DataFrame) -> DataFrame:
    """Events whose brand, by product id % 3, holds a line break and quotes, or two breaks on end; every fifth user's session holds one."""
    kind = F.col("product_id") % 3
    brand = F.when(kind == 1, F.concat("brand", F.lit('\n"x", y'))).when(kind == 2, F.concat(F.lit("a\n\n"), "brand")).otherwise(F.col("brand"))
    session = F.when(F.col("user_id") % 5 == 0, F.concat("user_session", F.lit("\n,end"))).otherwise(F.col("user_session"))
    return events.withColumn("brand", brand).withColumn("user_session", session)


def write_event_csv(events: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Events as CSV files with a header, NULL written as an empty field.

    Values are written verbatim: the writer's default trimming of leading and
    trailing spaces is switched off, quotes are doubled.
    """
    (csv_text_columns(events).write.mode(mode)
     .option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of the orders table (``ORDER_CHANGE_SCHEMA``), one scan, no shuffle.

    key % 3 == 0: insert only; == 1: insert, update; == 2: insert, delete;
    and key % 6 == 5 is re-inserted after its delete.
    """
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    base = F.col("o_totalprice").cast("decimal(10,2)")

    def change(step: int, op: str, amount, status):
        return F.struct(
            (key * 4 + step).alias("change_seq"), F.lit(op).alias("op"),
            key.cast("int").alias("order_id"),
            F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("customer_name"),
            F.concat(F.lit("priority "), F.col("o_orderpriority")).alias("product_name"),
            amount.cast("decimal(10,2)").alias("amount"), status.alias("status"),
            F.col("o_orderdate").alias("created_at"))

    steps = F.array(
        change(0, "insert", base, F.lit("new")),
        F.when(key % 3 == 1, change(1, "update", base + F.lit(10).cast("decimal(10,2)"), F.col("o_orderstatus"))),
        F.when(key % 3 == 2, change(1, "delete", base, F.lit("new"))),
        F.when(key % 6 == 5, change(2, "insert", base, F.lit("reinserted"))),
    )
    return o.select(F.inline(F.filter(steps, lambda s: s.isNotNull())))


def order_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of the orders table with images: an insert of every order, then by key % 3 == 1 an update as two rows, == 2 a delete.

    Every tenth row before an update is delivered twice.
    """
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")

    def row(step: int, op: str, amount, status):
        return F.struct((key * 2 + step).alias("commit_seq"), F.lit(0).alias("seq"), F.lit(op).alias("op"), key.cast("int").alias("order_id"),
                        F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("customer_name"),
                        F.concat(F.lit("priority "), F.col("o_orderpriority")).alias("product_name"),
                        amount.cast("decimal(10,2)").alias("amount"), status.alias("status"), F.col("o_orderdate").alias("created_at"))

    base = F.col("o_totalprice").cast("decimal(10,2)")
    raised = F.when(key % 6 == 1, base).otherwise(base + F.lit(10).cast("decimal(10,2)"))  # of every other update only the status changes
    before = row(1, "update_before", base, F.lit("new"))
    rows = F.array(row(0, "insert", base, F.lit("new")), F.when(key % 3 == 1, before), F.when((key % 3 == 1) & (key % 10 == 0), before),
                   F.when(key % 3 == 1, row(1, "update_after", raised, F.col("o_orderstatus"))),
                   F.when(key % 3 == 2, row(1, "delete", base, F.lit("new"))))
    return o.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


ORDER_CHANGES_SQL = """
with o as (select * from orders),
changes as (
  select o_orderkey * 4 as change_seq, 'insert' as op, o_orderkey, o_custkey, o_orderpriority,
         cast(o_totalprice as decimal(10,2)) as amount, 'new' as status, o_orderdate from o
  union all
  select o_orderkey * 4 + 1, 'update', o_orderkey, o_custkey, o_orderpriority,
         cast(cast(o_totalprice as decimal(10,2)) + 10 as decimal(10,2)), o_orderstatus, o_orderdate
  from o where o_orderkey % 3 = 1
  union all
  select o_orderkey * 4 + 1, 'delete', o_orderkey, o_custkey, o_orderpriority,
         cast(o_totalprice as decimal(10,2)), 'new', o_orderdate from o where o_orderkey % 3 = 2
  union all
  select o_orderkey * 4 + 2, 'insert', o_orderkey, o_custkey, o_orderpriority,
         cast(o_totalprice as decimal(10,2)), 'reinserted', o_orderdate from o where o_orderkey % 6 = 5
)
select change_seq, op, cast(o_orderkey as int) as order_id,
       'Customer#' || cast(o_custkey as varchar) as customer_name,
       'priority ' || o_orderpriority as product_name,
       amount, status, o_orderdate as created_at
from changes
"""
