"""The event contract: one fixed schema shared by every source and job.

``properties`` is carried as canonical JSON object text (``{"k":1}``), so the
lake stays readable by any Parquet reader; the strict validator parses it as a
VARIANT on the way in.  ``arrival_ts`` is the time the pipeline saw the event
(the broker record time on a live stream); ``timestamp`` is the client's.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values of the contract (must equal the reference's) -------------
# Allowed event types, in declaration order.
EVENT_TYPES = ("view_item", "add_to_cart", "checkout", "purchase", "product_view")
# Root string fields that must be present, non-null strings.
REQUIRED_STRING_FIELDS = ("anonymous_id", "session_id", "event_type", "page_url")
# Optional root string fields.
OPTIONAL_STRING_FIELDS = ("user_id", "referrer_url", "product_id")
# Fields of the nested device context, all optional strings.
DEVICE_FIELDS = ("os", "browser", "ip_address", "user_agent")
# Product id used when an event carries none (null, missing or empty).
DEFAULT_PRODUCT = "PROD_GENERAL"
# Default window of the speed layer.
SPEED_WINDOW = "60 seconds"
# Archive micro-batch: rows per flush and seconds between flushes.
ARCHIVE_BATCH_ROWS = 5000
ARCHIVE_FLUSH_SECONDS = 60
# ---------------------------------------------------------------------------

# Page URLs are built as prefix + product id; the host is deployment config.
DEFAULT_PAGE_URL_PREFIX = "https://shop.example.com/products/"

DEVICE_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in DEVICE_FIELDS])

CONTRACT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("anonymous_id", T.StringType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("page_url", T.StringType(), False),
    T.StructField("referrer_url", T.StringType(), True),
    T.StructField("device", DEVICE_SCHEMA, True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("properties", T.StringType(), False),
    T.StructField("arrival_ts", T.TimestampType(), True),
])

CONTRACT_COLUMNS = tuple(f.name for f in CONTRACT_SCHEMA.fields)

# What the archive keeps beside the typed columns: the whole message, and why the contract rejects it.
PAYLOAD_COLUMNS = ("raw", "reasons")
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("raw", T.StringType(), True),
    T.StructField("reasons", T.ArrayType(T.StringType()), True),
])

# Hive-style partition columns of the lake, zero-padded in paths.
LAKE_PARTITIONS = ("year", "month", "day", "hour")

LAKE_SCHEMA = T.StructType(
    list(CONTRACT_SCHEMA.fields) + list(PAYLOAD_SCHEMA.fields)
    + [T.StructField(p, T.IntegerType(), True) for p in LAKE_PARTITIONS])


def nullable(schema: T.StructType) -> T.StructType:
    """Same schema with every top-level field nullable (file sources need it)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
