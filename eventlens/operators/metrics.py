"""Lake and serving metrics: A4-A8, K1-K3, G3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.text import default_product

# Event type counted as a product view by the view counter (specified).
VIEW_EVENT_TYPES = ("product_view",)


def product_views(events: DataFrame, time_col: str = "arrival_ts",
                  view_types: Sequence[str] = VIEW_EVENT_TYPES) -> DataFrame:
    """A4 (+P12): running view count and last view time per product.

    Unwindowed: on a stream (update mode) the state is one row per product.
    """
    return (events
            .filter(F.col("event_type").isin(list(view_types)))
            .withColumn("product_id", default_product("product_id"))
            .groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("view_count"),
                 F.max(time_col).alias("last_viewed_at")))


def view_events(events: DataFrame, time_col: str = "arrival_ts", view_types: Sequence[str] = VIEW_EVENT_TYPES) -> DataFrame:
    """The events that A4 counts (product_id, viewed_at)."""
    return (events.filter(F.col("event_type").isin(list(view_types)))
            .select(default_product("product_id").alias("product_id"), F.col(time_col).alias("viewed_at")))


def trending_products(views: DataFrame, k: int = 10) -> DataFrame:
    """K1: the k most viewed products, ties broken by product_id.

    ``orderBy().limit()`` plans as TakeOrderedAndProject (each task keeps its
    own top k), and the rank is computed over those k rows only.
    """
    top = most_viewed(views, k)
    w = Window.orderBy(F.desc("view_count"))
    return top.withColumn("rank", F.rank().over(w).cast("int"))


def most_viewed(views: DataFrame, k: int) -> DataFrame:
    return views.orderBy(F.desc("view_count"), F.asc("product_id")).limit(k)


def ranked(top: DataFrame) -> DataFrame:
    """The few rows of a `most_viewed` with their ranks by view_count, in that order: one array, no window."""
    rows = F.sort_array(F.collect_list(F.struct((-F.col("view_count")).alias("_less"), *top.columns)))
    rank = lambda r: (F.size(F.filter("rows", lambda x: x["_less"] < r["_less"])) + 1).cast("int")
    return top.agg(rows.alias("rows")).select(F.inline(F.transform(
        "rows", lambda r: F.struct(*[r[c].alias(c) for c in top.columns], rank(r).alias("rank")))))


def events_by_type(events: DataFrame) -> DataFrame:
    """A5: total events per event_type."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def unique_users_sessions(events: DataFrame, user_col: str = "user_id",
                          session_col: str = "session_id") -> DataFrame:
    """A6 + A7: distinct users (nulls ignored) and distinct sessions."""
    return events.agg(F.count_distinct(F.col(user_col)).alias("unique_users"),
                      F.count_distinct(F.col(session_col)).alias("unique_sessions"))


def daily_trend(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """A5-A7 by UTC day: events, distinct users and sessions per day."""
    return (events
            .groupBy(F.to_date(time_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.count_distinct("session_id").alias("unique_sessions")))


def preview(df: DataFrame, n: int = 100, order: Sequence[str] = ("timestamp", "event_id")) -> DataFrame:
    """K2: the first n rows in a stable order (TakeOrderedAndProject)."""
    return df.orderBy(*[F.asc(c) for c in order]).limit(n)


def ingest_quality(validated: DataFrame) -> DataFrame:
    """Processed / accepted / rejected counts and the success percentage.

    ``validated`` is the output of :func:`eventlens.operators.validate.validate_json`.
    The rate is 0 for an empty input.  HTTP error classes are not modelled.
    """
    malformed = F.array_contains("reasons", "malformed_json") | F.array_contains("reasons", "not_an_object")
    agg = validated.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("is_valid")).alias("accepted_events"),
        F.count_if(~F.col("is_valid")).alias("rejected_events"),
        F.count_if(malformed).alias("malformed_events"))
    rate = F.when(F.col("total_events") > 0,
                  F.col("accepted_events").cast("double") * F.lit(100.0)
                  / F.col("total_events").cast("double")).otherwise(F.lit(0.0))
    return agg.withColumn("success_pct", rate)


def rejects_by_reason(validated: DataFrame) -> DataFrame:
    """Rejected events per reason (a row with two faults counts under both)."""
    return (validated
            .filter(~F.col("is_valid"))
            .select(F.explode("reasons").alias("reason"))
            .groupBy("reason")
            .agg(F.count(F.lit(1)).alias("rejected_events")))
