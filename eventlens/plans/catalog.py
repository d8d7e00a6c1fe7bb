"""Named queries: (spark, sf_dir) -> DataFrame, one per operator of the survey.

Each reads the driver's tables (or data Spark derives from them) in full.
Output columns are flat and timestamps are TIMESTAMP_NTZ (UTC wall clock), so
results compare directly with the DuckDB oracle in :mod:`eventlens.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.contract import CONTRACT_COLUMNS
from eventlens.operators import funnel, metrics, ordered, sketches, windows
from eventlens.operators.dedup import dedup_events
from eventlens.operators.normalize import normalize_export
from eventlens.operators.validate import accepted, validate_json
from eventlens.plans import derived
from eventlens.session import ensure_checkpoint_dir, ensure_utc, scratch_path
from eventlens.sinks.compaction import CompactedLake
from eventlens.sinks.serving import ServingTable
from eventlens.sinks.topic import canonical_message
from eventlens.sources.csv_export import read_export
from eventlens.sources.lake import lake_inventory, lake_slice, read_lake
from eventlens.streaming import jobs
from eventlens.streaming.corrections import Corrections

Query = Callable[[SparkSession, str], DataFrame]

WINDOWS = {"60s": "60 seconds", "1d": "1 day"}
ROLLING = {"60s": ("60 seconds", "30 seconds"), "1d": ("1 day", "6 hours")}
TOP_K = 10
PREVIEW_ROWS = 100
LAKE_DAY = 4
# Watermark delay of the stream replays: their files come in time order, so it
# only covers the disorder within a slice, whatever the table's span.
REPLAY_DELAY = "1 hour"
CART_IDLE = "1 day"
VISIT_IDLE = "2 hours"
MESSAGE_SCHEMA = "value string, arrival_ts timestamp, position bigint"


def ntz(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP columns to TIMESTAMP_NTZ (UTC wall clock) for output."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def state_partitions(spark: SparkSession) -> int:
    """State partitions of a replay: one for each core that the session has.  A stream keeps the number it first
    starts with."""
    return spark.sparkContext.defaultParallelism


def _prepare(spark: SparkSession) -> None:
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return derived.events_view(spark, sf_dir).select(*CONTRACT_COLUMNS)


FLAT_EVENT_COLUMNS = ["event_id", "timestamp", "user_id", "anonymous_id", "session_id",
                      "event_type", "page_url", "price", "product_id", "properties"]


# -- A1 / A2 / A3 / W10 ---------------------------------------------------------

def _product_window_counts(size: str) -> Query:
    def q(spark, sf_dir):
        return ntz(windows.product_window_counts(events(spark, sf_dir), WINDOWS[size]))
    return q


def _event_window_rollup(size: str) -> Query:
    def q(spark, sf_dir):
        served = windows.serving_projection(
            windows.product_window_counts(events(spark, sf_dir), WINDOWS[size]))
        return ntz(windows.event_window_rollup(served))
    return q


def _event_window_stats(size: str) -> Query:
    def q(spark, sf_dir):
        return ntz(windows.event_window_stats(events(spark, sf_dir), WINDOWS[size]))
    return q


def _rolling_counts(size: str) -> Query:
    length, slide = ROLLING[size]

    def q(spark, sf_dir):
        return ntz(windows.product_window_counts(events(spark, sf_dir), length, slide=slide))
    return q


# -- A4 / K1 / A5-A7 / G3 -----------------------------------------------------------

def product_views_total(spark, sf_dir):
    return ntz(metrics.product_views(events(spark, sf_dir)))


def trending_products(spark, sf_dir):
    return ntz(metrics.trending_products(metrics.product_views(events(spark, sf_dir)), TOP_K))


def unique_users_range(spark, sf_dir):
    """Users of every seven days, exactly, and whether the merged hourly sketches come within their bound."""
    every = events(spark, sf_dir)
    stored = scratch_path(spark, "sketches")
    sketches.hourly_sketches(every).write.parquet(stored)
    estimate = sketches.distinct_in_ranges(spark.read.parquet(stored))
    both = sketches.distinct_in_ranges_exact(every).join(estimate, ["range_start", "range_end"], "left")
    off = F.abs(F.col("users_estimate") - F.col("unique_users"))
    return ntz(both.select("range_start", "range_end", "unique_users",
                           F.coalesce(off <= F.lit(sketches.relative_error()) * F.col("unique_users"), F.lit(False))
                           .alias("within_bound")))


def trending_bounded(spark, sf_dir):
    """K1 by a summary of bounded size, proved by exact counts of its candidates."""
    views = metrics.view_events(events(spark, sf_dir))
    return ntz(sketches.trending_bounded(views, TOP_K))


def events_by_type(spark, sf_dir):
    return metrics.events_by_type(events(spark, sf_dir))


def unique_users_sessions(spark, sf_dir):
    return metrics.unique_users_sessions(events(spark, sf_dir))


def daily_trend(spark, sf_dir):
    return metrics.daily_trend(events(spark, sf_dir))


def conversion_funnel(spark, sf_dir):
    return funnel.conversion_funnel(events(spark, sf_dir))


def funnel_ordered(spark, sf_dir):
    return ordered.funnel_ordered(events(spark, sf_dir))


def abandoned_carts(spark, sf_dir):
    view = events(spark, sf_dir)
    last = view.agg(F.max("timestamp")).first()[0]  # idle as of the newest event
    return ntz(funnel.abandoned_carts(view, CART_IDLE, F.lit(last).cast("timestamp")))


def traffic_by_referrer(spark, sf_dir):
    return funnel.traffic_by_referrer(derived.with_referrers(events(spark, sf_dir)))


# -- P1-P9 / A8 --------------------------------------------------------------------

def _validated(spark, sf_dir):
    _prepare(spark)
    msgs = spark.read.parquet(derived.messages_path(spark, sf_dir))
    return validate_json(msgs, "value", arrival_col="arrival_ts", position_cols=["position"])


def strict_accepted(spark, sf_dir):
    v = _validated(spark, sf_dir).filter("is_valid")
    # a defaulted event_id is derived, not given: left out of comparisons
    eid = F.when(F.array_contains("defaulted", "event_id"), F.lit(None).cast("string")) \
        .otherwise(F.col("event_id"))
    return ntz(v.select(
        eid.alias("event_id"), "timestamp", "user_id", "anonymous_id", "session_id",
        "event_type", "page_url", "referrer_url",
        *[F.col(f"device.{f}").alias(f"device_{f}") for f in ("os", "browser", "ip_address", "user_agent")],
        "price", "product_id", "properties"))


def strict_rejected_by_reason(spark, sf_dir):
    return metrics.rejects_by_reason(_validated(spark, sf_dir))


def ingest_quality(spark, sf_dir):
    return metrics.ingest_quality(_validated(spark, sf_dir))


def routing_keys(spark, sf_dir):
    from eventlens.functions.text import routing_key
    return events(spark, sf_dir).select("event_id", routing_key().alias("routing_key"))


def canonical_messages(spark, sf_dir):
    return canonical_message(events(spark, sf_dir))


# -- N1-N8 -------------------------------------------------------------------------

def export_normalized(spark, sf_dir):
    _prepare(spark)
    raw = read_export(spark, derived.export_path(spark, sf_dir), derived.EXPORT_COLUMNS)
    out = normalize_export(raw)
    return ntz(out.select(*FLAT_EVENT_COLUMNS))


# -- W8 --------------------------------------------------------------------------------

def dedup_events_q(spark, sf_dir):
    _prepare(spark)
    twice = derived.with_duplicates(derived.events_view(spark, sf_dir)).select(*CONTRACT_COLUMNS)
    return ntz(dedup_events(twice).select(*FLAT_EVENT_COLUMNS))


# -- lake: S5 S3 P13 P14 P15 K2 S11 -------------------------------------------------

LAKE_OUTPUT = FLAT_EVENT_COLUMNS + ["year", "month", "day", "hour"]


def lake_day_slice(spark, sf_dir):
    _prepare(spark)
    root = derived.lake_root(spark, sf_dir)
    return ntz(lake_slice(spark, root, day=LAKE_DAY).select("*").select(*LAKE_OUTPUT))


def lake_preview(spark, sf_dir):
    _prepare(spark)
    root = derived.lake_root(spark, sf_dir)
    return ntz(metrics.preview(read_lake(spark, root), PREVIEW_ROWS).select(*LAKE_OUTPUT))


def lake_inventory_q(spark, sf_dir):
    _prepare(spark)
    root = derived.lake_root(spark, sf_dir)
    return lake_inventory(spark, root).select("year", "month", "day", "hour", "n_rows")


def archive_payload(spark, sf_dir):
    """What the typed columns can't hold comes back from the archived message."""
    _prepare(spark)
    sent = read_lake(spark, derived.archive_root(spark, sf_dir)).select(
        *[F.get_json_object("raw", f"$.{p}").alias(n) for n, p in
          (("email", "email"), ("screen", "device.screen"), ("user_sent", "user_id"))],
        F.col("event_id").isNull().alias("id_lost"), (F.size("reasons") > 0).alias("rejected"))
    return sent.groupBy(*sent.columns).agg(F.count(F.lit(1)).alias("messages"))


def lake_dedup(spark, sf_dir):
    """W8 over the archive: numeric ids are null there, absent ones derived, every 7th event came twice."""
    _prepare(spark)
    unique = dedup_events(read_lake(spark, derived.archive_root(spark, sf_dir)))
    return unique.groupBy("event_type", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("event_id").alias("ids"))


def lake_compacted(spark, sf_dir):
    """Hours of a lake of small files after they are merged: files, rows and what the rows hold."""
    _prepare(spark)
    lake = CompactedLake(derived.small_files_root(spark, sf_dir))
    lake.compact(spark)
    hours = ["year", "month", "day", "hour"]
    files = lake.files(spark).groupBy(*hours).agg(F.count(F.lit(1)).alias("n_files"))
    rows = lake.read(spark).groupBy(*hours).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("event_id").cast("bigint")).alias("id_sum"),
        F.count_distinct("event_id").alias("ids"), F.count("product_id").alias("products"),
        F.max("properties").alias("last_properties"))
    return rows.join(files, hours)


# -- streams: S7 W2 W7 W8 W9 --------------------------------------------------------

def _stream(build, keys, duplicates=False):
    def q(spark, sf_dir):
        _prepare(spark)
        src = derived.replay_path(spark, sf_dir, duplicates=duplicates)
        out = jobs.run_to_table(spark, build, src, keys,
                                serving_root=scratch_path(spark, "serving"),
                                checkpoint=scratch_path(spark, "checkpoint"),
                                max_files_per_trigger=2,
                                state_partitions=state_partitions(spark))
        return ntz(out)
    return q


def _stream_product_counts(size):
    return _stream(lambda s: jobs.speed_layer(s, REPLAY_DELAY, WINDOWS[size]), jobs.PRODUCT_COUNT_KEYS)


def _stream_event_stats(size):
    """A3 exact on a stream: a count query and a dedup-then-count query run
    side by side over the same replay, joined at read time."""
    def q(spark, sf_dir):
        _prepare(spark)
        src = derived.replay_path(spark, sf_dir)
        counts = ServingTable(scratch_path(spark, "serving"), jobs.EVENT_STATS_KEYS)
        users = ServingTable(scratch_path(spark, "serving"), jobs.EVENT_STATS_KEYS)
        jobs.run_to_tables(spark, src, [
            (lambda s: jobs.stats_count_layer(s, REPLAY_DELAY, WINDOWS[size]), counts,
             scratch_path(spark, "checkpoint")),
            (lambda s: jobs.stats_users_layer(s, REPLAY_DELAY, WINDOWS[size]), users,
             scratch_path(spark, "checkpoint")),
        ], max_files_per_trigger=2, state_partitions=state_partitions(spark))
        return ntz(jobs.read_stats(spark, counts, users))
    return q


stream_product_views = _stream(lambda s: jobs.views_layer(s), jobs.PRODUCT_VIEW_KEYS)
stream_dedup_counts = _stream(lambda s: jobs.dedup_speed_layer(s, REPLAY_DELAY, WINDOWS["60s"]),
                              jobs.PRODUCT_COUNT_KEYS, duplicates=True)


def stream_late_counts(spark, sf_dir):
    """Rows and late rows of a replay whose last file is a late second delivery."""
    _prepare(spark)
    table = ServingTable(scratch_path(spark, "serving"), jobs.LATE_KEYS)
    stream = jobs.file_event_stream(spark, derived.late_path(spark, sf_dir), 1)
    jobs.drain(jobs.late_counts(stream, table, scratch_path(spark, "checkpoint"), REPLAY_DELAY, WINDOWS["60s"]))
    return table.read(spark).agg(F.sum("rows").alias("rows"), F.sum("late").alias("late"))


def stream_late_corrected(spark, sf_dir):
    """A1 served from a replay with late second deliveries, the windows they touch counted again."""
    _prepare(spark)
    src = derived.late_path(spark, sf_dir)
    served = ServingTable(scratch_path(spark, "serving"), jobs.PRODUCT_COUNT_KEYS)
    fixed = Corrections(scratch_path(spark, "corrections"), WINDOWS["60s"])
    speed = jobs.speed_layer(jobs.file_event_stream(spark, src, 1), REPLAY_DELAY, WINDOWS["60s"])
    jobs.drain(jobs.serve(speed, served, scratch_path(spark, "checkpoint"), state_partitions=state_partitions(spark)),
               fixed.start(jobs.file_event_stream(spark, src, 1), scratch_path(spark, "checkpoint")))
    return ntz(fixed.read(spark, served))


def stream_abandoned_carts(spark, sf_dir):
    """Abandoned visits that are over at the end of the replay."""
    _prepare(spark)
    table = ServingTable(scratch_path(spark, "serving"), jobs.VISIT_KEYS)
    stream = jobs.file_event_stream(spark, derived.replay_path(spark, sf_dir), 2)
    jobs.drain(jobs.serve_abandoned_visits(stream, table, scratch_path(spark, "checkpoint"), REPLAY_DELAY, VISIT_IDLE,
                                           state_partitions=state_partitions(spark)))
    return ntz(table.read(spark))


def stream_state_audit(spark, sf_dir):
    """The windows that A1 holds open after the replay, read from its state, beside what it served."""
    _prepare(spark)
    table = ServingTable(scratch_path(spark, "serving"), jobs.PRODUCT_COUNT_KEYS)
    checkpoint = scratch_path(spark, "checkpoint")
    stream = jobs.file_event_stream(spark, derived.replay_path(spark, sf_dir), 2)
    jobs.drain(jobs.serve(jobs.speed_layer(stream, REPLAY_DELAY, WINDOWS["1d"]), table, checkpoint,
                          state_partitions=state_partitions(spark),
                          conf={"spark.sql.streaming.noDataMicroBatches.enabled": "true"}))
    return ntz(jobs.state_differences(spark, checkpoint, table))


def stream_event_rollup_view(spark, sf_dir):
    """A2 over the stream-served A1 table."""
    return windows.event_window_rollup(_stream_product_counts("60s")(spark, sf_dir))


def stream_trending(spark, sf_dir):
    """K1 over the stream-served A4 table."""
    return metrics.trending_products(stream_product_views(spark, sf_dir), TOP_K)


def stream_json_product_counts(spark, sf_dir):
    """JSON topic text to served counts: strict validation and A1 in one stream."""
    _prepare(spark)
    messages = (spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2)
                .parquet(derived.messages_path(spark, sf_dir)))
    valid = accepted(validate_json(messages, "value", arrival_col="arrival_ts", position_cols=["position"]))
    table = ServingTable(scratch_path(spark, "serving"), jobs.PRODUCT_COUNT_KEYS)
    jobs.drain(jobs.serve(jobs.speed_layer(valid, REPLAY_DELAY, WINDOWS["60s"]), table,
                          scratch_path(spark, "checkpoint"), state_partitions=state_partitions(spark)))
    return ntz(table.read(spark))


_ingested: dict[tuple, tuple[str, str]] = {}


def _ingest(spark, sf_dir):
    """Drain the message replay through the ingest job (lake + quarantine),
    once per session and scale; both ingest queries read its two outputs."""
    _prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _ingested and all(derived.exists(spark, p) for p in _ingested[key]):
        return _ingested[key]
    src = derived.messages_path(spark, sf_dir)
    lake, quarantine = scratch_path(spark, "lake"), scratch_path(spark, "quarantine")
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2).parquet(src)
    queries = jobs.ingest_streams(stream, lake, quarantine, scratch_path(spark, "checkpoint"),
                                  available_now=True, position_cols=["position"])
    jobs.drain(*queries)
    _ingested[key] = (lake, quarantine)
    return lake, quarantine


def stream_ingest_lake(spark, sf_dir):
    lake, _ = _ingest(spark, sf_dir)
    return lake_inventory(spark, lake).select("year", "month", "day", "hour", "n_rows")


def stream_ingest_quarantine(spark, sf_dir):
    _, quarantine = _ingest(spark, sf_dir)
    return (spark.read.parquet(quarantine).select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("messages")))


QUERIES: dict[str, Query] = {}
for _s in WINDOWS:
    QUERIES[f"product_window_counts_{_s}"] = _product_window_counts(_s)
for _s in WINDOWS:
    QUERIES[f"event_window_rollup_{_s}"] = _event_window_rollup(_s)
for _s in WINDOWS:
    QUERIES[f"event_window_stats_{_s}"] = _event_window_stats(_s)
for _s in ROLLING:
    QUERIES[f"rolling_counts_{_s}"] = _rolling_counts(_s)
QUERIES.update({
    "product_views_total": product_views_total,
    "trending_products": trending_products,
    "trending_bounded": trending_bounded,
    "events_by_type": events_by_type,
    "unique_users_range": unique_users_range,
    "unique_users_sessions": unique_users_sessions,
    "daily_trend": daily_trend,
    "conversion_funnel": conversion_funnel,
    "funnel_ordered": funnel_ordered,
    "abandoned_carts": abandoned_carts,
    "traffic_by_referrer": traffic_by_referrer,
    "strict_accepted": strict_accepted,
    "strict_rejected_by_reason": strict_rejected_by_reason,
    "ingest_quality": ingest_quality,
    "routing_keys": routing_keys,
    "canonical_messages": canonical_messages,
    "export_normalized": export_normalized,
    "dedup_events": dedup_events_q,
    "lake_day_slice": lake_day_slice,
    "lake_preview": lake_preview,
    "lake_inventory": lake_inventory_q,
})
for _s in WINDOWS:
    QUERIES[f"stream_product_counts_{_s}"] = _stream_product_counts(_s)
for _s in WINDOWS:
    QUERIES[f"stream_event_stats_{_s}"] = _stream_event_stats(_s)
QUERIES["archive_payload"] = archive_payload
QUERIES["lake_dedup"] = lake_dedup
QUERIES["lake_compacted"] = lake_compacted
QUERIES["stream_json_product_counts"] = stream_json_product_counts
QUERIES["stream_event_rollup_view"] = stream_event_rollup_view
QUERIES["stream_trending"] = stream_trending
QUERIES["stream_product_views"] = stream_product_views
QUERIES["stream_dedup_counts"] = stream_dedup_counts
QUERIES["stream_late_counts"] = stream_late_counts
QUERIES["stream_late_corrected"] = stream_late_corrected
QUERIES["stream_abandoned_carts"] = stream_abandoned_carts
QUERIES["stream_state_audit"] = stream_state_audit
QUERIES["stream_ingest_lake"] = stream_ingest_lake
QUERIES["stream_ingest_quarantine"] = stream_ingest_quarantine
