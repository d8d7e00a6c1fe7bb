"""Streaming jobs (S7, W1-W11): source -> operator -> keyed serving table.

Every job takes an explicit ``time_col`` and watermark ``delay``.  Late rows
(older than the watermark) are dropped by Spark; the delay is a required
parameter because the right value depends on the source.  Jobs run either
continuously (``processingTime``) or as a drain (``availableNow``), with a
checkpoint that makes restarts resume exactly where they stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.functions.contract import CONTRACT_SCHEMA, SPEED_WINDOW, nullable
from eventlens.operators.dedup import dedup_events
from eventlens.operators.funnel import abandoned_visits
from eventlens.operators.metrics import product_views
from eventlens.operators.windows import (
    event_window_counts, event_window_stats, product_window_counts, serving_projection, window_users,
)
from eventlens.sinks.serving import ServingTable


def file_event_stream(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Contract events from Parquet files dropped into ``path`` (the offline
    stand-in for the topic: files are picked up once, in arrival order)."""
    reader = spark.readStream.schema(nullable(CONTRACT_SCHEMA))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def serve(result: DataFrame, table: ServingTable, checkpoint: str, *,
          available_now: bool = True, interval: str = "1 second",
          query_name: str | None = None, state_partitions: int | None = None,
          write: Callable[[DataFrame, int], None] | None = None,
          output_mode: str = "update", conf: dict[str, str] | None = None) -> StreamingQuery:
    """Run ``result`` into ``table`` via foreachBatch (``write``, if not its upsert).

    A stateful query takes its number of state partitions from
    ``spark.sql.shuffle.partitions`` when it first starts (the checkpoint keeps
    it afterwards).  ``state_partitions`` sets it, and ``conf`` other settings, for
    this query only; the session's values are restored once the query has started.
    """
    writer = (result.writeStream.outputMode(output_mode)
              .foreachBatch(write or table.upsert)
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=interval)
    own = dict(conf or {})
    if state_partitions:
        own["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    spark = result.sparkSession
    previous = {key: spark.conf.get(key) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        return writer.start()
    finally:
        for key, value in previous.items():
            spark.conf.set(key, value)


def tap(df: DataFrame, name: str, time_col: str = "arrival_ts") -> DataFrame:
    """Per-micro-batch metrics instead of per-row logging.

    Rows, rows per event type of interest and the event-time range of each
    batch show up in ``StreamingQueryProgress.observedMetrics[name]``; late
    rows can be spotted as ``min_time`` below the previous watermark.
    """
    return df.observe(name,
                      F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("product_id").isNull() | (F.col("product_id") == "")).alias("no_product"),
                      F.count_if(F.col(time_col).isNull()).alias("no_time"),  # these enter no window
                      F.min(time_col).alias("min_time"),
                      F.max(time_col).alias("max_time"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators dropped as older than the watermark, after their partial aggregation
    and within the progress reports that Spark keeps (100 by default): at most the late events. :func:`late_counts`
    counts all of them."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def late_counts(events: DataFrame, table: ServingTable, checkpoint: str, delay: str, window: str = SPEED_WINDOW,
                time_col: str = "arrival_ts", **how) -> StreamingQuery:
    """Each micro-batch's late events, counted before any aggregation, into ``table`` (key: ``LATE_KEYS``).

    An event is late when its window has ended at the watermark in force.  As in Spark's windowed aggregation that
    is the latest time of the batches before the previous one (to the millisecond, not before 1970) less ``delay``.
    The times come from the table itself, so a restart goes on with them and a retried batch counts the same.
    The batches are those of this query: Spark's own count may differ by a batch where another query's differ.
    """
    def count(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            before = table.read(spark).filter(F.col("batch") < batch_id - 1)
            latest = before.agg(F.unix_millis(F.max("max_time"))).first()[0]
        except FileNotFoundError:  # the first batch
            latest = None
        epoch = F.timestamp_millis(F.lit(0))
        mark = epoch if latest is None else F.greatest(
            epoch, F.timestamp_millis(F.lit(latest)) - F.expr(f"interval {delay}"))
        timed = batch.filter(F.col(time_col).isNotNull())  # window() drops the others
        late = timed.select(F.window(time_col, window).end.alias("end")).agg(F.count_if(F.col("end") <= mark).alias("late"))
        rows = batch.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(time_col).isNull()).alias("no_time"),
                         F.max(time_col).alias("max_time"))
        table.upsert(rows.crossJoin(late).select(
            F.lit(int(batch_id)).cast("long").alias("batch"), "rows", "no_time", "late", mark.alias("watermark"),
            "max_time"), batch_id)

    return serve(events, table, checkpoint, write=count, **how)


def ingest_rate(query: StreamingQuery) -> dict[str, float]:
    """A8's duration and throughput, from the query's progress reports."""
    reports = [p for p in query.recentProgress if p.get("numInputRows", 0) > 0]
    rows = sum(p["numInputRows"] for p in reports)
    ms = sum(p["durationMs"].get("triggerExecution", 0) for p in reports)
    return {"batches": len(reports), "events": rows, "duration_sec": ms / 1000.0,
            "events_per_sec": rows * 1000.0 / ms if ms else 0.0}


# -- the four served metrics ---------------------------------------------------

PRODUCT_COUNT_KEYS = ("event_type", "window_end", "product_id")
EVENT_STATS_KEYS = ("event_type", "window_start", "window_end")
PRODUCT_VIEW_KEYS = ("product_id",)
LATE_KEYS = ("batch",)


def speed_layer(events: DataFrame, delay: str, window: str = SPEED_WINDOW,
                time_col: str = "arrival_ts") -> DataFrame:
    """A1 on a stream: served rows (event_type, window_end, product_id, count)."""
    tapped = tap(events, "speed_input", time_col)
    return serving_projection(
        product_window_counts(tapped.withWatermark(time_col, delay), window, time_col))


def stats_layer(events: DataFrame, delay: str, window: str = SPEED_WINDOW,
                time_col: str = "arrival_ts") -> DataFrame:
    """A3 on a stream in one query, with approximate distinct users (HLL)."""
    return event_window_stats(events.withWatermark(time_col, delay), window, time_col,
                              distinct="approx")


def stats_count_layer(events: DataFrame, delay: str, window: str = SPEED_WINDOW,
                      time_col: str = "arrival_ts") -> DataFrame:
    """A3, exact, part 1: events per (event_type, window)."""
    return event_window_counts(events, window, time_col, delay)


def stats_users_layer(events: DataFrame, delay: str, window: str = SPEED_WINDOW,
                      time_col: str = "arrival_ts", user_col: str = "user_id") -> DataFrame:
    """A3, exact, part 2: distinct users per (event_type, window)."""
    return window_users(events, window, time_col, user_col, delay)


def read_stats(spark: SparkSession, counts: ServingTable, users: ServingTable) -> DataFrame:
    """The A3 serving view: counts joined with distinct users (0 when none)."""
    c = counts.read(spark)
    u = users.read(spark)
    return (c.join(u, list(EVENT_STATS_KEYS), "left")
            .select(*EVENT_STATS_KEYS, "event_count",
                    F.coalesce(F.col("unique_users"), F.lit(0)).cast("long").alias("unique_users")))


def views_layer(events: DataFrame, time_col: str = "arrival_ts") -> DataFrame:
    """A4 on a stream: one row per product, unbounded by time."""
    return product_views(events, time_col)


# Settings of a query over visits: a visit's events meet in its task before the shuffle, so a busy one is a row a
# task, and visits that ended by the last watermark come out without waiting for more events.
VISIT_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
              "spark.sql.streaming.noDataMicroBatches.enabled": "true"}
VISIT_KEYS = ("session_id", "visit_start")


def serve_abandoned_visits(events: DataFrame, table: ServingTable, checkpoint: str, delay: str, idle: str = "30 minutes",
                           time_col: str = "arrival_ts", **how) -> StreamingQuery:
    """G2 on a stream: each abandoned visit goes into ``table`` (key: ``VISIT_KEYS``) once, when the watermark says that
    it is over.  State is a row for each visit that may still go on."""
    visits = abandoned_visits(events.withWatermark(time_col, delay), idle, time_col)
    return serve(visits, table, checkpoint, output_mode="append", conf=VISIT_CONF, **how)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What A1's state holds, read back from the checkpoint of a stopped query: the counts of the windows that the
    watermark has not passed, in the columns of the served table."""
    state = spark.read.format("statestore").load(checkpoint)
    kind, product, window = [f"key.`{c}`" for c in _state_keys(state)]
    return state.select(F.col(kind).alias("event_type"), F.col(f"{window}.end").alias("window_end"),
                        F.col(product).alias("product_id"), F.col("value.count").alias("event_count"))


def _state_keys(state: DataFrame) -> tuple[str, str, str]:
    """The type's, product's and window's name in the state's key, where Spark has its own name for the window."""
    names = state.schema["key"].dataType
    window = next(f.name for f in names if f.dataType.typeName() == "struct")
    return "event_type", next(f.name for f in names if f.name not in ("event_type", window)), window


def state_differences(spark: SparkSession, checkpoint: str, table: ServingTable) -> DataFrame:
    """Windows still open in the state beside the served rows: a row for each, with both counts (null: not served)."""
    served = table.read(spark).withColumnRenamed("event_count", "served_count")
    return (open_windows(spark, checkpoint).withColumnRenamed("event_count", "state_count")
            .join(served, list(PRODUCT_COUNT_KEYS), "left"))


def dedup_speed_layer(events: DataFrame, delay: str, window: str = SPEED_WINDOW,
                      time_col: str = "arrival_ts") -> DataFrame:
    """W8 then A1: duplicates within the watermark are counted once."""
    unique = dedup_events(events, "event_id", time_col, delay)
    return serving_projection(product_window_counts(unique, window, time_col))


def run_to_tables(spark: SparkSession, source_path: str,
                  layers: Sequence[tuple[Callable[[DataFrame], DataFrame], ServingTable, str]],
                  max_files_per_trigger: int | None = None,
                  state_partitions: int | None = None) -> None:
    """Drain one source through several independent queries at once."""
    queries = []
    for build, table, checkpoint in layers:
        stream = file_event_stream(spark, source_path, max_files_per_trigger)
        queries.append(serve(build(stream), table, checkpoint, available_now=True,
                             state_partitions=state_partitions))
    drain(*queries)


def drain(*queries: StreamingQuery) -> None:
    """Wait for drains to end; raise what one of them failed with."""
    for q in queries:
        q.awaitTermination()
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def run_to_table(spark: SparkSession, build: Callable[[DataFrame], DataFrame],
                 source_path: str, keys: Sequence[str], serving_root: str, checkpoint: str,
                 max_files_per_trigger: int | None = None,
                 state_partitions: int | None = None) -> DataFrame:
    """Drain ``source_path`` through ``build`` into a serving table and return
    the table's current contents as a batch DataFrame."""
    stream = file_event_stream(spark, source_path, max_files_per_trigger)
    table = ServingTable(serving_root, keys)
    drain(serve(build(stream), table, checkpoint, available_now=True, state_partitions=state_partitions))
    return table.read(spark)


def ingest_streams(messages: DataFrame, lake_root: str, quarantine_root: str, checkpoint_root: str,
                   time_col: str = "arrival_ts", available_now: bool = False,
                   interval: str = "60 seconds",
                   position_cols: Sequence[str] = ()) -> tuple[StreamingQuery, StreamingQuery]:
    """The batch layer: message text -> lake archive + quarantine.

    ``messages`` has ``value`` (JSON text) and ``arrival_ts`` (broker record
    time), e.g. :func:`eventlens.sources.kafka.read_topic`.  Every message that
    parses as a JSON object is archived whole under its arrival hour, valid or
    not (the archive applies no contract); malformed text and bare scalars go
    to the quarantine with their reasons.  Both are file sinks with their own
    checkpoints, so each output is exactly-once; each parses the text, but only
    the archive looks its fields up and checks them.
    """
    from eventlens.operators.validate import archivable, unreadable, validate_json
    from eventlens.sinks.archive import archive_stream

    validated = validate_json(messages, "value", arrival_col="arrival_ts", position_cols=position_cols)
    lake_q = archive_stream(archivable(validated), lake_root, f"{checkpoint_root}/lake", time_col,
                            available_now=available_now)
    bad = unreadable(messages, "value", "arrival_ts").withColumn("day", F.to_date("arrival_ts"))
    writer = (bad.writeStream.format("parquet")
              .option("path", quarantine_root)
              .option("checkpointLocation", f"{checkpoint_root}/quarantine")
              .partitionBy("day").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return lake_q, writer.start()
