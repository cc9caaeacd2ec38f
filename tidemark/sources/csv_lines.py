"""CSV records whose quoted values hold line breaks, read from files that stay splittable.

Spark's text source deals a file out in splits of lines. A line starts inside a quoted value if the
quotes before it in its file are odd: their parity is summed within each split and moved up by that of
earlier splits (one number for each). Lines that are records by themselves go on as they are; only the
lines of longer records are gathered, a record to a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.schema import CORRUPT_COLUMN, CSV_SCHEMA, MAX_RECORD_LINES

FILE = ["file", "block"]  # a split: its file and where it starts
POSITION = "position"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its place and whether it holds an odd number of quotes."""
    read = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("row"), (quotes % 2).alias("odd"))


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with ``starts`` (a record begins here), ``at`` (block and row where its record began) and ``header``."""
    in_block = Window.partitionBy(*FILE).orderBy("row")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = lines.groupBy(*FILE).agg(F.sum("odd").alias("odds")).select(
        *FILE, F.coalesce(F.sum("odds").over(blocks), F.lit(0)).alias("odds_before"))
    marked = lines.withColumn("before", before).withColumn("first", F.row_number().over(in_block) == 1).join(parity, FILE)
    marked = marked.withColumn("starts", (F.col("before") + F.col("odds_before")) % 2 == 0)
    begun = marked.withColumn("last", F.max(F.when(F.col("starts"), F.col("row"))).over(so_far))
    # a record that began in an earlier block began at that block's last start
    last = marked.where("starts").groupBy(*FILE).agg(F.max("row").alias("row"))
    heads = lines.select(*FILE).distinct().join(last, FILE, "left").select(*FILE, F.max(
        F.when(F.col("row").isNotNull(), F.struct("block", "row"))).over(blocks).alias("earlier"))
    own = F.when(F.col("last").isNotNull(), F.struct("block", F.col("last").alias("row")))
    return begun.join(heads, FILE).select("value", *FILE, "row", "odd", "starts", F.coalesce(own, F.col("earlier")).alias("at"),
                                          (F.col("first") & (F.col("block") == 0)).alias("header"))


def csv_records(spark: SparkSession, path: str, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """``record, position, closed`` of every record but the first of each file, its header; blank lines are passed over.

    ``position`` (file, block, row of the first line) orders the records of a file as they stand. A
    quote that is never closed would draw in the rest of its file: a record of more than ``max_lines``
    lines is not put together, each of its lines is a record that is not ``closed``. So is a last record
    whose quote stays open.
    """
    lines = _placed(_lines(spark, path))
    one = F.col("starts") & (F.col("odd") == 0)
    position = F.struct("file", F.col("at.block").alias("block"), F.col("at.row").alias("row")).alias(POSITION)
    bare = F.regexp_replace("value", "\r$", "").alias("record")
    single = lines.where(one & ~F.col("header") & (F.trim(F.regexp_replace("value", "\r$", "")) != "")).select(
        bare, position, F.lit(True).alias("closed"))
    longer = lines.where(~one)
    sizes = longer.groupBy("file", "at").agg(F.count("*").alias("lines"), (F.sum("odd") % 2 == 0).alias("closed"))
    small = F.col("lines") <= max_lines
    sized = longer.join(sizes, ["file", "at"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "row", "value"))), lambda x: x["value"]), "\n")
    joined = sized.where(small).groupBy("file", "at", "closed").agg(text.alias("value"), F.max("header").alias("header")).where(
        ~F.col("header")).select(bare, position, "closed")
    runaway = sized.where(~small).select(bare, F.struct("file", "block", "row").alias(POSITION), F.lit(False).alias("closed"))
    return single.unionByName(joined).unionByName(runaway)


def read_records(spark: SparkSession, path: str, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """Records as the all-text columns of ``CSV_SCHEMA``, with ``position``. A record that is not closed has no fields and is corrupt."""
    names = CSV_SCHEMA.fieldNames()
    ddl = ", ".join(f"{n} string" for n in names)
    parsed = F.from_csv(F.col("record"), ddl, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    rows = csv_records(spark, path, max_lines).select("record", "closed", POSITION, parsed.alias("p"))
    fields = [F.when(F.col("closed"), F.col(f"p.{n}")).alias(n) for n in names[:-1]]
    return rows.select(*fields, F.when(F.col("closed"), F.col(f"p.{CORRUPT_COLUMN}")).otherwise(F.col("record")).alias(CORRUPT_COLUMN), POSITION)
