"""Time-window counts: A1 (per product), A2 (rollup), A3 (stats), W1, W10.

Windows are aligned to the epoch, like the speed layer's tumbling window.  All
counts are built-in aggregates, so Spark adds a map-side partial aggregate
before the shuffle: a hot product or event type is collapsed per task before it
reaches the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.contract import SPEED_WINDOW
from eventlens.functions.text import default_product
from eventlens.operators.dedup import STREAM_DEDUP_SALTS


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _panes(window: str, slide: str) -> int:
    """How many slides make a window; 1 if they don't or the durations have another form than ``N unit``."""
    found = []
    for text in (window, slide):
        number, _, unit = text.strip().partition(" ")
        size = _SECONDS.get(unit.strip().rstrip("s"))
        if not number.isdigit() or size is None:
            return 1
        found.append(int(number) * size)
    length, step = found
    return length // step if step and length % step == 0 else 1


def _window(time_col: str, duration: str, slide: str | None) -> Column:
    if slide is None or slide == duration:
        return F.window(F.col(time_col), duration)
    return F.window(F.col(time_col), duration, slide)


def product_window_counts(events: DataFrame, window: str = SPEED_WINDOW,
                          time_col: str = "arrival_ts", slide: str | None = None) -> DataFrame:
    """A1 (+P10, P11, W1, W10): events per (event_type, product_id, window).

    ``slide`` smaller than ``window`` gives rolling (hopping) windows; each
    event then counts in window/slide windows.  Output columns: event_type,
    product_id, window_start, window_end, event_count (BIGINT).
    """
    keyed = events.withColumn("product_id", default_product("product_id"))
    panes = _panes(window, slide) if slide and not events.isStreaming else 1
    if panes > 1:
        # count once per slide, then let each pane's count enter the windows that hold it
        keys = ["event_type", "product_id"]
        pane = (keyed.groupBy(F.window(F.col(time_col), slide).alias("pane"), *keys)
                .agg(F.count(F.lit(1)).alias("event_count")))
        back = F.explode(F.transform(F.sequence(F.lit(0), F.lit(panes - 1)),
                                     lambda i: F.col("pane.start") - i * F.expr(f"INTERVAL {slide}")))
        return (pane.withColumn("window_start", back)
                .groupBy(*keys, "window_start").agg(F.sum("event_count").alias("event_count"))
                .select(*keys, "window_start",
                        (F.col("window_start") + F.expr(f"INTERVAL {window}")).alias("window_end"), "event_count"))
    return (keyed
            .groupBy(_window(time_col, window, slide).alias("window"),
                     F.col("event_type"), F.col("product_id"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select("event_type", "product_id",
                    F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "event_count"))


def serving_projection(counts: DataFrame) -> DataFrame:
    """The served row (event_type, window_end, product_id, event_count)."""
    return counts.select("event_type", "window_end", "product_id", "event_count")


def event_window_rollup(product_counts: DataFrame) -> DataFrame:
    """A2: the rollup view, SUM(event_count) per (event_type, window_end).

    Runs over A1's served table (already aggregated, so this shuffle is small).
    """
    return (product_counts
            .groupBy("event_type", "window_end")
            .agg(F.sum("event_count").alias("event_count")))


def event_window_stats(events: DataFrame, window: str = SPEED_WINDOW,
                       time_col: str = "arrival_ts", user_col: str = "user_id",
                       distinct: str = "exact") -> DataFrame:
    """A3 (+W7): per (event_type, window): event_count and unique_users.

    Batch, ``distinct='exact'``: COUNT(DISTINCT), planned as two exchanges
    ((key, user), then key), so a hot window is first deduplicated per user.
    ``distinct='approx'``: HyperLogLog++ (``approx_count_distinct``), whose
    state is a fixed-size sketch; this is the single-query form for streams.
    The exact streaming form is two queries (see ``streaming.jobs``): counts,
    and :func:`window_users` followed by a count.
    Null users (anonymous visitors) are not counted.
    """
    if distinct == "approx":
        users = F.approx_count_distinct(user_col)
    elif events.isStreaming:
        raise ValueError("exact distinct users on a stream: use streaming.jobs.stats_users_layer")
    else:
        users = F.count_distinct(F.col(user_col))
    return (events
            .groupBy(_window(time_col, window, None).alias("window"), F.col("event_type"))
            .agg(F.count(F.lit(1)).alias("event_count"), users.cast("long").alias("unique_users"))
            .select("event_type",
                    F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "event_count", "unique_users"))


def with_window_bounds(events: DataFrame, window: str = SPEED_WINDOW,
                       time_col: str = "arrival_ts") -> DataFrame:
    """Add plain ``window_start`` / ``window_end`` timestamps (tumbling, epoch
    aligned).  Computed before any watermark, they carry no event-time mark,
    so a stream can put its watermark on ``window_end`` instead."""
    return (events.withColumn("_w", F.window(F.col(time_col), window))
            .withColumn("window_start", F.col("_w.start"))
            .withColumn("window_end", F.col("_w.end"))
            .drop("_w"))


def event_window_counts(events: DataFrame, window: str = SPEED_WINDOW,
                        time_col: str = "arrival_ts", delay: str | None = None) -> DataFrame:
    """A3's event_count alone, per (event_type, window).

    On a stream (``delay`` required) the watermark is on ``window_end``: a row
    is late once its whole window is older than the watermark.
    """
    bounded = with_window_bounds(events, window, time_col)
    if events.isStreaming:
        bounded = bounded.withWatermark("window_end", _need(delay))
    return (bounded.groupBy("event_type", "window_start", "window_end")
            .agg(F.count(F.lit(1)).alias("event_count")))


def window_users(events: DataFrame, window: str = SPEED_WINDOW, time_col: str = "arrival_ts",
                 user_col: str = "user_id", delay: str | None = None) -> DataFrame:
    """A3's unique_users as dedup-then-count, exact on a stream.

    Each (window, event_type, user) is kept once, then counted.  On a stream
    the dedup is ``dropDuplicatesWithinWatermark`` with the watermark on
    ``window_end``, so an entry lives until its window is past the watermark;
    the state is one small entry per key, spread over state partitions by
    hash, so a window with millions of users is not gathered into one row.
    Same late-data rule as :func:`event_window_counts`.
    """
    keyed = (with_window_bounds(events.filter(F.col(user_col).isNotNull()), window, time_col)
             .select("window_start", "window_end", "event_type", F.col(user_col).alias("_user"),
                     F.col(time_col).alias("_at")))
    keys = ["window_start", "window_end", "event_type", "_user"]
    if events.isStreaming:
        # twice, first under a salt, so that one user's storm of events is spread over tasks (see dedup_events)
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), F.col("_at")), F.lit(STREAM_DEDUP_SALTS))
        firsts = (keyed.withWatermark("window_end", _need(delay)).withColumn("_salt", salt)
                  .dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt", "_at")
                  .dropDuplicatesWithinWatermark(keys))
    else:
        firsts = keyed.dropDuplicates(keys)
    return (firsts.groupBy("event_type", "window_start", "window_end")
            .agg(F.count(F.lit(1)).alias("unique_users")))


def _need(delay: str | None) -> str:
    if delay is None:
        raise ValueError("a streaming window needs a watermark delay")
    return delay
