"""CSV event files: header row, then nine positional text columns.

Read with an all-text schema plus the corrupt-record column, then typed
with strict casts. Files are read in splits, also where quoted values hold line breaks
(``multi_line``, see `csv_lines`); only a stream reads files whole then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fence import fence
from tidemark.functions.scalar import empty_to_null, strict_decimal, strict_long
from tidemark.functions.time import parse_utc_text
from tidemark.operators.validate import REASON, first_reason, typed_checks
from tidemark.schema import CORRUPT_COLUMN, CSV_SCHEMA, EVENT_COLUMNS
from tidemark.sources.csv_lines import FILE, POSITION, read_records

_CASTS = {
    "event_time": parse_utc_text,
    "event_type": lambda c: c,
    "product_id": strict_long,
    "category_id": strict_long,
    "category_code": empty_to_null,
    "brand": empty_to_null,
    "price": strict_decimal,
    "user_id": strict_long,
    # an empty session stays empty (the reader turns it into NULL)
    "user_session": lambda c: F.coalesce(c, F.lit("")),
}


def csv_reader(spark: SparkSession, multi_line: bool = False, stream: bool = False,
               max_files_per_trigger: int | None = None):
    """Reader (batch or stream) with the all-text schema and the corrupt-record column."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.schema(CSV_SCHEMA)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .option("escape", '"')
            .option("multiLine", multi_line))


def type_csv(raw: DataFrame, clamp_days: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """All-text CSV rows -> canonical events + ``reject_reason`` + ``raw_record``.

    The raw row is fenced first: the parser then always tokenizes all nine
    fields, so a short or long row is flagged whichever columns are used.
    The typed values and the reason are fenced as well, so the reject split
    filters on a plain column instead of parsing times and numbers again.
    ``clamp_days`` resolves a day past the month's end to its last day; without
    it the row is rejected. Columns past the ninth are passed over. ``raw_record``
    parses to the same fields again: quoted where a value needs it. ``keep`` names columns to carry along.
    """
    fields = CSV_SCHEMA.fieldNames()
    raw = fence(raw, keep, **{n: F.col(n) for n in fields})
    fields = [*keep, *fields]
    casts = dict(_CASTS, event_time=lambda c: parse_utc_text(c, clamp_days))
    values = {n: f"_{n}" for n in EVENT_COLUMNS}
    typed = fence(raw, fields, **{values[n]: casts[n](F.col(n)) for n in EVENT_COLUMNS})
    # a corrupt row is short or long: fields are counted with quoted ones set aside
    unquoted = F.regexp_replace(CORRUPT_COLUMN, r'"([^"]|"")*"', "")
    short = F.col(CORRUPT_COLUMN).isNotNull() & (F.size(F.split(unquoted, ",", -1)) < len(EVENT_COLUMNS))
    checks = [(short, "short_row")]
    for name in ("event_time", "event_type", "product_id", "category_id", "price", "user_id"):
        checks.append((F.col(name).isNull(), f"missing_{name}"))
        if name == "event_type":
            checks += typed_checks(F.col, required=(name,))[1:]
        else:
            checks.append((F.col(values[name]).isNull(), f"bad_{name}"))
    checked = fence(typed, [*fields, *values.values()], **{REASON: first_reason(checks)})
    whole = F.to_csv(F.struct(*[F.col(n) for n in EVENT_COLUMNS]), {
        "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    raw_record = F.when(F.col(REASON).isNotNull(), F.coalesce(F.col(CORRUPT_COLUMN), whole))
    return checked.select(*keep, *[F.col(v).alias(n) for n, v in values.items()], REASON, raw_record.alias("raw_record"))


def with_split(raw: DataFrame) -> DataFrame:
    """Rows of a file reader with ``file`` and ``block``, the start of their split in it."""
    return raw.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def with_position(rows: DataFrame) -> DataFrame:
    """Rows with ``file`` and ``block``, in the order they were read, with their ``position``. Those of a file ascend as they stand."""
    place = F.struct("file", "block", F.monotonically_increasing_id().alias("row"))
    return rows.select(*[c for c in rows.columns if c not in FILE], place.alias(POSITION))


def read_csv_events(spark: SparkSession, path: str, multi_line: bool = False,
                    clamp_days: bool = True, position: bool = False) -> DataFrame:
    """CSV file(s) -> canonical events + ``reject_reason`` (see ``operators.validate.split``).

    ``position`` adds each record's place, by which events are previewed in file order
    and cut at the first error (``operators.validate.until_first_error``).
    """
    keep = (POSITION,) if position else ()
    if multi_line:
        return type_csv(read_records(spark, path), clamp_days, keep)
    raw = csv_reader(spark).csv(path)
    return type_csv(with_position(with_split(raw)) if position else raw, clamp_days, keep)
