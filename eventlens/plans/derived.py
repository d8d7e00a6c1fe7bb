"""Inputs derived by Spark from the driver's ``events`` table.

The reference's inputs are JSON messages, CSV exports and a stream; the
driver's table is neither.  These builders derive them deterministically, so
every query's work grows with the table, and the DuckDB oracle can state the
expected answer from the same rows.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.contract import CONTRACT_COLUMNS
from eventlens.operators.validate import archivable, validate_json
from eventlens.session import scratch_path
from eventlens.sinks.archive import write_lake
from eventlens.sources.replay import contract_events, read_table

# Device values of the derived JSON messages: os-0, browser-0, ... by the user's number.
DEVICE_KINDS = 6
DEVICE_AGENT = "fixture/1"

# Fault injected into message i by i % 50 (FIXTURES.md §3).
FAULTS = {
    0: "malformed JSON",
    1: "session_id missing",
    2: "page_url null",
    3: "user_id as a number",
    4: "price as a string (accepted)",
    5: "padded anonymous_id (accepted, trimmed)",
    6: "undeclared field (accepted, dropped)",
    7: "properties null",
    8: "event_id absent (accepted, defaulted)",
    9: "bare JSON 42",
    10: "event_id as a number",
    11: "white space before the object (accepted)",
    12: "price text with a type suffix",
}


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows plus raw_event_type / raw_user_id / raw_event_id."""
    return contract_events(read_table(spark, sf_dir, "events"), keep_raw_type=True)


def with_referrers(view: DataFrame) -> DataFrame:
    """The events with a referrer derived from props.k: none for two in five, else one of seven sites
    (with user info and port, which are no part of the host)."""
    k = F.get_json_object("properties", "$.k").cast("int")
    url = F.concat(F.lit("https://u:p@Site"), (k % 7).cast("string"), F.lit(".example.com:8080/a?q="), k.cast("string"))
    return view.withColumn("referrer_url", F.when(~(k % 5).isin(0, 1), url))


def _json(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]),
                     {"ignoreNullFields": "false"})


def json_messages(view: DataFrame) -> DataFrame:
    """One JSON text per event with the injected faults; columns value, arrival_ts."""
    uid = F.col("raw_user_id")
    device = F.struct(
        F.concat(F.lit("os-"), (uid % DEVICE_KINDS).cast("string")).alias("os"),
        F.concat(F.lit("browser-"), (uid % DEVICE_KINDS).cast("string")).alias("browser"),
        F.lit(None).cast("string").alias("ip_address"),
        F.lit(DEVICE_AGENT).alias("user_agent"),
        F.lit("1920x1080").alias("screen"))
    base = {
        "event_id": F.col("event_id"),
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "user_id": F.col("user_id"),
        "anonymous_id": F.col("anonymous_id"),
        "session_id": F.col("session_id"),
        "event_type": F.col("event_type"),
        "page_url": F.col("page_url"),
        "referrer_url": F.col("referrer_url"),
        "device": device,
        "price": F.col("price"),
        "product_id": F.col("product_id"),
        "properties": F.parse_json(F.col("properties")),
    }

    def variant(**changes) -> Column:
        fields = dict(base)
        for k, v in changes.items():
            if v is None:
                fields.pop(k)
            else:
                fields[k] = v
        return _json(fields)

    normal = variant()
    m = F.col("raw_event_id") % 50
    value = (F.when(m == 0, F.expr("substring(_normal, 1, length(_normal) - 1)"))
             .when(m == 1, variant(session_id=None))
             .when(m == 2, variant(page_url=F.lit(None).cast("string")))
             .when(m == 3, variant(user_id=uid))
             .when(m == 4, variant(price=F.col("price").cast("string")))
             .when(m == 5, variant(anonymous_id=F.concat(F.lit(" \t"), F.col("anonymous_id"), F.lit("  "))))
             .when(m == 6, variant(email=F.lit("someone@example.com")))
             .when(m == 7, variant(properties=F.lit(None).cast("string")))
             .when(m == 8, variant(event_id=None))
             .when(m == 9, F.lit("42"))
             .when(m == 10, variant(event_id=F.col("raw_event_id")))
             .when(m == 11, F.concat(F.lit("\n\t"), F.col("_normal")))
             .when(m == 12, variant(price=F.concat(F.col("price").cast("string"), F.lit("d"))))
             .otherwise(F.col("_normal")))
    return (view.withColumn("_normal", normal)
            .select(value.alias("value"), F.col("arrival_ts"), F.col("raw_event_id")))


def csv_export_frame(view: DataFrame) -> DataFrame:
    """An e-commerce export (snake_case header style) derived from the events.

    Raw types are kept unmapped (the lenient job maps them); every 13th row
    lacks a session; brand carries padding that the job strips.
    """
    k = F.get_json_object(F.col("properties"), "$.k")
    ki = k.cast("int")
    return view.select(
        F.concat(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        F.col("raw_event_type").alias("event_type"),
        F.nullif(F.col("product_id"), F.lit("")).alias("product_id"),
        k.alias("category_id"),
        F.when(ki % 3 == 0, F.lit("electronics.smartphone")).alias("category_code"),
        F.when(ki % 4 == 0, F.lit("  acme ")).alias("brand"),
        F.col("price").cast("string").alias("price"),
        F.col("user_id").alias("user_id"),
        F.when(F.col("raw_event_id") % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("session_id")).alias("user_session"))


# A replay has some slices where it is large enough for slices of so many rows, and more only where one (a file,
# written by one task) would exceed the largest size; so jobs don't grow with rows below millions of them.
REPLAY_SLICES = 8
REPLAY_ROWS = 12_500
REPLAY_ROWS_MOST = 500_000
SLICE_ROW_GROUP = 2 << 20  # bytes: the least that a task of a replay reads


EXPORT_COLUMNS = ["event_time", "event_type", "product_id", "category_id", "category_code",
                  "brand", "price", "user_id", "user_session"]


def with_duplicates(view: DataFrame) -> DataFrame:
    """The events plus a second delivery of every 7th one (W8 input)."""
    again = view.filter(F.col("raw_event_id") % 7 == 0)
    return view.unionByName(again)


# -- shared materialisations (one per session and scale) -----------------------

_cache: dict[tuple, str] = {}
_lock = threading.RLock()  # a materialisation may need another one


def exists(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(p)
    except Exception:
        return False


def _materialise(spark: SparkSession, kind: str, sf_dir: str, build) -> str:
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    with _lock:
        path = _cache.get(key)
        if path and exists(spark, path):
            return path
        path = scratch_path(spark, kind)
        build(path)
        _cache[key] = path
        return path


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """The contract events archived to a partitioned lake (S5 + P15)."""
    def build(p):
        write_lake(events_view(spark, sf_dir).select(*CONTRACT_COLUMNS), p)
    return _materialise(spark, "lake", sf_dir, build)


def small_files_root(spark: SparkSession, sf_dir: str) -> str:
    """The contract events archived in two runs, which leave a file or two each in every hour."""
    def build(p):
        view = events_view(spark, sf_dir)
        for k in (0, 1):
            write_lake(view.filter(F.col("raw_event_id") % 2 == k).select(*CONTRACT_COLUMNS), p,
                       partitions=spark.sparkContext.defaultParallelism)
    return _materialise(spark, "lake-small", sf_dir, build)


def export_path(spark: SparkSession, sf_dir: str) -> str:
    """The derived CSV export written once with a header."""
    def build(p):
        csv_export_frame(events_view(spark, sf_dir)).write.option("header", True).csv(p)
    return _materialise(spark, "export", sf_dir, build)


def replay_path(spark: SparkSession, sf_dir: str, duplicates: bool = False, rows: int = REPLAY_ROWS) -> str:
    """Contract events as time-ordered Parquet files of at least about ``rows`` rows
    (`slice_count`), the input of the file-stream replays.

    A file stream takes files by modification time, so the slices are written
    one after the other, in time order: arrival order is event order.
    """
    def build(p):
        view = events_view(spark, sf_dir)
        if duplicates:
            view = with_duplicates(view)
        _write_slices(view.select(*CONTRACT_COLUMNS), p, rows)
    kind = "replay-dups" if duplicates else "replay"
    return _materialise(spark, kind, sf_dir, build)


def late_path(spark: SparkSession, sf_dir: str) -> str:
    """The replay, then the events of the latest time again, then every 7th event again: the input of the late
    counts, one file (slice) a batch, whose last one is read under a watermark of the latest time."""
    def build(p):
        view = events_view(spark, sf_dir)
        _write_slices(view.select(*CONTRACT_COLUMNS), p, REPLAY_ROWS)
        latest = view.agg(F.max("arrival_ts").alias("latest"))
        for again in (view.join(F.broadcast(latest), F.col("arrival_ts") == F.col("latest")),
                      view.filter(F.col("raw_event_id") % 7 == 0)):
            again.select(*CONTRACT_COLUMNS).write.mode("append").parquet(p)
    return _materialise(spark, "replay-late", sf_dir, build)


def slice_count(rows: int, size: int = REPLAY_ROWS, most: int = REPLAY_ROWS_MOST) -> int:
    return max(1, min(REPLAY_SLICES, -(-rows // size)), -(-rows // most))


def _write_slices(rows: DataFrame, path: str, size: int,
                  finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append consecutive time ranges (`slice_count`) to ``path``, a file each, one after the other, rows without a time
    first.  The table is dealt out once by (time, row), so equal times spread over slices too, and each slice is
    read from its own folder.  ``finish`` derives what is written from the rows dealt out: the range bounds are sampled
    from the rows as they come, so work done before would be done twice, and by as few tasks as the table has splits.
    A file's row groups are small, so several tasks share the reading of one file."""
    spark = rows.sparkSession
    n = slice_count(rows.count(), size)
    staged = scratch_path(spark, "slices")
    dealt = (rows.withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(n, F.asc_nulls_first("arrival_ts"), "_row").drop("_row"))
    done = finish(dealt) if finish else dealt
    (done.withColumn("_slice", F.spark_partition_id()).sortWithinPartitions("_slice", F.asc_nulls_first("arrival_ts"))
     .write.partitionBy("_slice").parquet(staged))
    for k in range(n):
        if exists(spark, f"{staged}/_slice={k}"):  # the range bounds are sampled: a slice may be empty
            (spark.read.schema(done.schema).parquet(f"{staged}/_slice={k}").coalesce(1)
             .write.mode("append").option("parquet.block.size", SLICE_ROW_GROUP).parquet(path))


def messages_path(spark: SparkSession, sf_dir: str) -> str:
    """The fault-injected JSON messages at rest (value, arrival_ts, position), as
    a topic would hold them, in time-ordered files like `replay_path`; the
    input of the JSON streams."""
    def messages(dealt: DataFrame) -> DataFrame:
        return json_messages(contract_events(dealt, keep_raw_type=True)).select(
            "value", "arrival_ts", F.col("raw_event_id").alias("position"))

    def build(p):
        table = read_table(spark, sf_dir, "events")
        _write_slices(table.withColumn("arrival_ts", F.col("ts").cast("timestamp")), p, REPLAY_ROWS, messages)
    return _materialise(spark, "messages", sf_dir, build)


def archive_root(spark: SparkSession, sf_dir: str) -> str:
    """The messages, every 7th delivered twice, archived whole to a lake."""
    def build(p):
        sent = spark.read.parquet(messages_path(spark, sf_dir))
        again = sent.filter(F.col("position") % 7 == 0)
        kept = archivable(validate_json(sent.unionByName(again), "value", "arrival_ts", position_cols=["position"]))
        # validated once: the ranges of the write are sampled from what lies in files
        staged = scratch_path(spark, "validated")
        kept.write.parquet(staged)
        write_lake(spark.read.parquet(staged), p)
    return _materialise(spark, "archive", sf_dir, build)
