"""A6 / A7 / K1 in bounded space: distinct users of any range from stored hourly sketches, and the top k from a
summary of fixed size whose answer is proved by exact counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.operators.metrics import most_viewed, ranked

# A Theta sketch of 2^12 entries counts up to 4,096 values exactly; beyond, its relative error has this standard deviation.
LG_ENTRIES = 12


def relative_error(lg_entries: int = LG_ENTRIES, deviations: float = 3.0) -> float:
    """The share by which an estimate of a union may be off (at three deviations: once in 370 estimates)."""
    return deviations / 2.0 ** (lg_entries / 2)


def hourly_sketches(events: DataFrame, time_col: str = "timestamp", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """A row an hour: sketches of its users and sessions (at most 64 KB each).  Null ids and events without a time count
    nowhere.  Sketches merge before the shuffle, so a busy hour sends a row a task."""
    return (events.filter(F.col(time_col).isNotNull())
            .groupBy(F.date_trunc("hour", time_col).alias("hour"))
            .agg(F.theta_sketch_agg("user_id", lg_entries).alias("users"),
                 F.theta_sketch_agg("session_id", lg_entries).alias("sessions")))


def distinct_in_ranges(sketches: DataFrame, span: str = "7 days", slide: str = "1 day",
                       lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Estimated distinct users and sessions of every range of ``span``, from sketches alone."""
    ranges = sketches.groupBy(F.window("hour", span, slide).alias("r")).agg(
        *[F.theta_sketch_estimate(F.theta_union_agg(c, lg_entries)).alias(f"{c}_estimate") for c in ("users", "sessions")])
    return ranges.select(F.col("r.start").alias("range_start"), F.col("r.end").alias("range_end"),
                         "users_estimate", "sessions_estimate")


def distinct_between(sketches: DataFrame, start, end, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """One row: estimated distinct users and sessions with ``start <= hour < end``; 0 for no hour."""
    part = sketches.filter((F.col("hour") >= F.lit(start).cast("timestamp")) & (F.col("hour") < F.lit(end).cast("timestamp")))
    return part.agg(*[F.coalesce(F.theta_sketch_estimate(F.theta_union_agg(c, lg_entries)), F.lit(0)).alias(f"{c}_estimate")
                      for c in ("users", "sessions")])


def users_in_both(sketches: DataFrame, first: Column, second: Column, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Estimated users seen in hours of ``first`` and again in hours of ``second`` (conditions on ``hour``); the error is
    relative to the smaller union, not to the result."""
    none = F.theta_sketch_agg(F.lit(None).cast("string"), lg_entries)
    both = sketches.agg(F.theta_union_agg(F.when(first, F.col("users")), lg_entries).alias("a"),
                        F.theta_union_agg(F.when(second, F.col("users")), lg_entries).alias("b"), none.alias("none"))
    return both.select(F.theta_sketch_estimate(F.theta_intersection(F.coalesce("a", "none"), F.coalesce("b", "none")))
                       .alias("users_estimate"))


def distinct_in_ranges_exact(events: DataFrame, span: str = "7 days", slide: str = "1 day",
                             time_col: str = "timestamp") -> DataFrame:
    """Exact distinct users of the ranges, from events (``slide`` divides a day or is days): what the estimates are held to."""
    daily = (events.filter(F.col(time_col).isNotNull())
             .select(F.date_trunc("hour", time_col).alias("hour"), "user_id").distinct())
    return (daily.groupBy(F.window("hour", span, slide).alias("r")).agg(F.count_distinct("user_id").alias("unique_users"))
            .select(F.col("r.start").alias("range_start"), F.col("r.end").alias("range_end"), "unique_users"))


def trending_bounded(views: DataFrame, k: int = 10, tracked: int = 4096) -> DataFrame:
    """K1 over view events (``product_id``, ``viewed_at``) without a state row for every product.

    A frequent-items summary of at most ``tracked`` products names the candidates; a second pass counts the candidates
    alone.  A product that is none of them has no more views than the candidates leave over, and at most 5.25 /
    ``tracked`` of all (twice the summary's error bound, as the summary names no product below it).  Where the last of
    the candidates' top k has more than that, it is the top k of all; where it has not (flat counts), every product is
    counted: the answer is exact either way.
    """
    found = views.agg(F.count("product_id").alias("n"),
                      F.expr(f"approx_top_k(product_id, {int(tracked)}, {int(tracked)})").alias("top")).first()
    names = [t["item"] for t in found["top"] or [] if t["item"] is not None]  # at most `tracked`
    total = (views.filter(F.col("product_id").isNotNull()).groupBy("product_id")
             .agg(F.count(F.lit(1)).alias("view_count"), F.max("viewed_at").alias("last_viewed_at")))
    mine = total.filter(F.col("product_id").isin(names))
    counts = sorted((r["view_count"] for r in mine.select("view_count").collect()), reverse=True)
    others = min(found["n"] - sum(counts), 5.25 * found["n"] / tracked)
    proved = others <= 0 or (len(counts) >= k and counts[k - 1] > others)
    return ranked(most_viewed(mine if proved else total, k))
