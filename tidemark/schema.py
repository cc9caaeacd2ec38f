"""Schemas and fixed values of the event model.

Every StructType is explicit: no source here ever infers a schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the original pipeline's for equal results.
# Event type wire values, matched case-sensitively, in declaration order.
EVENT_TYPES = ("view", "cart", "purchase")
# Tumbling event-time window length of both jobs.
WINDOW = "1 minute"
# Bounded out-of-orderness of the watermark.
MAX_DELAY = "5 seconds"
# An input without records for this long no longer holds windows open.
IDLE_LIMIT = "10 seconds"
# Size of the per-window category ranking.
TOP_N = 5
# Category given to events whose category code is NULL.
UNKNOWN_CATEGORY = "unknown"
# Result-table sink: rows per batch, flush interval, retries.
SINK_BATCH_ROWS = 100
SINK_FLUSH_INTERVAL = "5 seconds"
SINK_MAX_RETRIES = 3
# Poll timeout of the plain consumer (its micro-batch interval here).
CONSUMER_POLL_INTERVAL = "1 second"
# Text rendering of window bounds (UTC).
TEXT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
# CSV event time: text in TEXT_TIME_PATTERN followed by a 4-character zone suffix.
CSV_TIME_SUFFIX_LEN = 4
# Replay pacing of the CSV producer.
REPLAY_EVENTS_PER_SECOND = 50
# Records between two progress marks of the CSV producer.
PROGRESS_EVERY = 1000
# Rows shown by the parser preview.
PREVIEW_ROWS = 10
# Default topic names.
EVENTS_TOPIC = "ecommerce-events"
MANUAL_TOPIC = "manual-events"
# Web form defaults, in field order: eventType, productId, categoryId,
# categoryCode, brand, price, userId, userSession.
FORM_DEFAULTS = ("view", "123456", "2053013552326770905", "", "", "99.99", "1", "")
# --- end of fixed values.

# State stores of the windowed jobs: three event types, some hundred categories, two open windows.
STATE_PARTITIONS = {"event_type": 4, "category": 8}

# How far behind the newest event a record that is delivered again is still known.
REDELIVERY_HORIZON = "1 hour"

# A replay: files to a micro-batch, partitions of a folder topic, records to a file of it.
REPLAY_FILES = 8
TOPIC_PARTITIONS = 4
RECORDS_PER_FILE = 100_000

# Canonical typed event. event_time is TIMESTAMP_NTZ holding the UTC
# wall-clock time, so results never depend on the session time zone.
PRICE_TYPE = T.DecimalType(38, 18)
EVENT_FIELDS = (
    ("event_time", T.TimestampNTZType()),
    ("event_type", T.StringType()),
    ("product_id", T.LongType()),
    ("category_id", T.LongType()),
    ("category_code", T.StringType()),
    ("brand", T.StringType()),
    ("price", PRICE_TYPE),
    ("user_id", T.LongType()),
    ("user_session", T.StringType()),
)
EVENT_COLUMNS = tuple(name for name, _ in EVENT_FIELDS)
EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])

# JSON wire names, in the same order as EVENT_COLUMNS.
WIRE_NAMES = (
    "eventTime", "eventType", "productId", "categoryId", "categoryCode",
    "brand", "price", "userId", "userSession",
)
WIRE_OF = dict(zip(EVENT_COLUMNS, WIRE_NAMES))

# CSV: header row, then the nine columns in EVENT_COLUMNS order, all text.
CORRUPT_COLUMN = "_corrupt_record"
CSV_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in EVENT_COLUMNS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Lines that a record with quoted line breaks may have; beyond, its quote counts as never closed.
MAX_RECORD_LINES = 1000

# Manual request: eight text fields (no time; the server stamps it).
REQUEST_FIELDS = WIRE_NAMES[1:]
REQUEST_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in REQUEST_FIELDS])

# Topic record as a consumer sees it.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# Result tables.
EVENT_TYPE_COUNTS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampNTZType(), True),
    T.StructField("window_end", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_count", T.LongType(), False),
])
CATEGORY_TOP_N_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampNTZType(), True),
    T.StructField("window_end", T.TimestampNTZType(), True),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("category_code", T.StringType(), True),
    T.StructField("event_count", T.LongType(), False),
])

# Order change rows (change capture of the orders table).
ORDER_CHANGE_SCHEMA = T.StructType([
    T.StructField("change_seq", T.LongType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("order_id", T.IntegerType(), False),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("amount", T.DecimalType(10, 2), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])
# Hash buckets of the order state table.
STATE_BUCKETS = 16
ORDER_COLUMNS = ("order_id", "customer_name", "product_name", "amount", "status", "created_at")
