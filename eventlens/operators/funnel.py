"""Named-but-undefined goals, with our definitions: G1 funnel, G2 abandoned
carts, G4 traffic by referrer.  All are one aggregation per session (partial
aggregation first, so a hot session is merged map-side) plus a small rollup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Funnel steps in order; a step may be reached through several event types.
FUNNEL_STEPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("view", ("view_item", "product_view")),
    ("add_to_cart", ("add_to_cart",)),
    ("checkout", ("checkout",)),
    ("purchase", ("purchase",)),
)


def _first_at(types: Sequence[str], time_col: str) -> Column:
    return F.min(F.when(F.col("event_type").isin(list(types)), F.col(time_col)))


def session_funnel(events: DataFrame, time_col: str = "timestamp",
                   steps=FUNNEL_STEPS) -> DataFrame:
    """Per session, the first time of each step and the deepest step reached.

    A session reaches step k when it has every step 1..k and their first
    occurrences are in order (t1 <= t2 <= ... <= tk).
    """
    per_session = events.groupBy("session_id").agg(
        *[_first_at(types, time_col).alias(f"t_{name}") for name, types in steps])
    reached = F.lit(0)
    ok = F.lit(True)
    prev = None
    for i, (name, _) in enumerate(steps, start=1):
        t = F.col(f"t_{name}")
        ok = ok & t.isNotNull() & (F.lit(True) if prev is None else t >= prev)
        reached = F.when(ok, F.lit(i)).otherwise(reached)
        prev = t
    return per_session.withColumn("depth", reached)


def conversion_funnel(events: DataFrame, time_col: str = "timestamp",
                      steps=FUNNEL_STEPS) -> DataFrame:
    """G1: sessions reaching each step (step_no, step, sessions)."""
    depth = session_funnel(events, time_col, steps)
    counts = depth.agg(*[F.count_if(F.col("depth") >= i).alias(f"s{i}")
                         for i in range(1, len(steps) + 1)])
    stack = ", ".join(f"{i}, '{name}', s{i}" for i, (name, _) in enumerate(steps, start=1))
    return counts.selectExpr(f"stack({len(steps)}, {stack}) AS (step_no, step, sessions)")


def abandoned_carts(events: DataFrame, idle: str = "30 minutes", as_of: Column | None = None,
                    time_col: str = "timestamp") -> DataFrame:
    """Sessions whose last add_to_cart has no purchase at or after it, and
    which have been idle for ``idle`` as of ``as_of`` (default: now)."""
    now = as_of if as_of is not None else F.current_timestamp()
    t = F.col(time_col)
    s = events.groupBy("session_id").agg(
        F.max(F.when(F.col("event_type") == "add_to_cart", t)).alias("last_cart_at"),
        F.max(F.when(F.col("event_type") == "purchase", t)).alias("last_purchase_at"),
        F.max(t).alias("last_event_at"),
        F.count_if(F.col("event_type") == "add_to_cart").alias("cart_events"))
    return (s.filter(F.col("last_cart_at").isNotNull()
                     & (F.col("last_purchase_at").isNull() | (F.col("last_purchase_at") < F.col("last_cart_at")))
                     & (F.col("last_event_at") <= now - F.expr(f"INTERVAL {idle}")))
            .select("session_id", "last_cart_at", "last_event_at", "cart_events"))


def abandoned_visits(events: DataFrame, idle: str = "30 minutes", time_col: str = "timestamp") -> DataFrame:
    """G2 by visits: a visit is a run of a session's events no more than ``idle`` apart; it is abandoned when nothing is
    bought at or after its last add_to_cart.  The same for a table and, in append mode and with a watermark, for a
    stream, where a visit comes out once the watermark is ``idle`` past its last event.  Events without a session or
    time belong to no visit."""
    t = F.col(time_col)
    visits = (events.filter(F.col("session_id").isNotNull() & t.isNotNull())
              .groupBy("session_id", F.session_window(t, idle).alias("visit"))
              .agg(F.max(F.when(F.col("event_type") == "add_to_cart", t)).alias("last_cart_at"),
                   F.max(F.when(F.col("event_type") == "purchase", t)).alias("last_purchase_at"),
                   F.max(t).alias("last_event_at"),
                   F.count_if(F.col("event_type") == "add_to_cart").alias("cart_events")))
    return (visits.filter(F.col("last_cart_at").isNotNull()
                          & (F.col("last_purchase_at").isNull() | (F.col("last_purchase_at") < F.col("last_cart_at"))))
            .select("session_id", F.col("visit.start").alias("visit_start"), "last_cart_at", "last_event_at", "cart_events"))


def traffic_by_referrer(events: DataFrame) -> DataFrame:
    """Events and sessions per referrer host; no referrer is '(direct)'.
    (The contract has no campaign field; the referrer host stands in.)"""
    host = F.lower(F.try_parse_url(F.col("referrer_url"), F.lit("HOST")))
    source = F.coalesce(F.nullif(host, F.lit("")), F.lit("(direct)"))
    return (events.groupBy(source.alias("referrer_host"))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.count_distinct("session_id").alias("sessions")))
