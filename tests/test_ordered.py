"""Ordered folds against a plain loop, hot keys, ties, and the funnel over the order of events."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventlens.operators import ordered

START = dt.datetime(2024, 1, 1)


def loop(rows, machine):
    """State per key by sorting; rows of (key, time, symbol)."""
    out = {}
    for key in {r[0] for r in rows if r[1] is not None}:
        state = 0
        for _, s in sorted({(t, s) for k, t, s in rows if k == key and t is not None and s is not None}):
            state = machine.table[s][state]
        out[key] = state
    return out


def fold(spark, rows, machine):
    df = spark.createDataFrame(rows, "k string, timestamp timestamp, s int")
    return {r.k: r.state for r in ordered.ordered_fold(df, ["k"], F.col("s"), machine).collect()}


@pytest.mark.parametrize("seed, spread", [(0, 20), (1, 10**5), (2, 10**9), (3, 10**14)])
def test_any_machine_equals_a_loop(spark, seed, spread):
    rng = random.Random(seed)
    n = rng.randint(2, 16)
    machine = ordered.Machine(tuple(tuple(rng.randrange(n) for _ in range(n)) for _ in range(3)))
    rows = [(rng.choice(["a", "b", "c", None]), START + dt.timedelta(microseconds=rng.randrange(-spread, spread)),
             rng.choice([0, 1, 2, None])) for _ in range(600)]
    rows += rows[:50] + [("a", None, 1), ("only nothing", START, None), ("no time", None, 0)]
    assert fold(spark, rows, machine) == loop(rows, machine)


def test_times_far_apart_and_before_1970(spark):
    machine = ordered.steps_machine(3)
    times = [dt.datetime(1905, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2200, 1, 1)]
    rows = [("a", t, i) for i, t in enumerate(times)] + [("b", t, 2 - i) for i, t in enumerate(times)]
    assert fold(spark, rows, machine) == {"a": 3, "b": 1}


def test_machines_are_checked():
    for bad in (((0, 2),), ((),), ((0, 1), (0,)), (tuple(range(17)),)):
        with pytest.raises(ValueError):
            ordered.Machine(bad)
    assert ordered.Machine((tuple(range(15, -1, -1)),)).packed([15] * 16) == -1  # all 64 bits


def _events(spark, rows):
    return spark.createDataFrame([(s, START + dt.timedelta(minutes=m), t) for s, m, t in rows],
                                 "session_id string, timestamp timestamp, event_type string")


def test_funnel_takes_steps_in_order(spark):
    walk = ["add_to_cart", "product_view", "add_to_cart", "checkout", "purchase"]
    df = _events(spark, [("late view", i, t) for i, t in enumerate(walk)]
                 + [("backwards", i, t) for i, t in enumerate(walk[::-1])]
                 + [("one minute", 0, t) for t in walk] + [("nothing", 0, "error")])
    depth = {r.session_id: r.depth for r in ordered.session_depth(df).collect()}
    assert depth == {"late view": 4, "backwards": 2, "one minute": 4, "nothing": 0}
    assert [tuple(r) for r in ordered.funnel_ordered(df).collect()] == [
        (1, "view", 3), (2, "add_to_cart", 3), (3, "checkout", 2), (4, "purchase", 2)]
    assert [r.sessions for r in ordered.funnel_ordered(df.limit(0)).collect()] == [0] * 4


def test_a_hot_session_is_spread_over_tasks(spark):
    """A session with a third of all rows: its blocks of time lie in many tasks on every level but the last."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("session_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        F.element_at(F.array(*(F.lit(t) for t in ("product_view", "add_to_cart", "checkout", "purchase"))),
                     (F.floor(F.col("id") / 3) % 4 + 1).cast("int")).alias("event_type"))
    out = ordered.session_depth(df)
    depth = {r.session_id: r.depth for r in out.filter("session_id = 'hot'").collect()}
    assert depth == {"hot": 4}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        first = (df.withColumn("block", F.shiftright(F.unix_micros("timestamp"), ordered.FIRST_BITS))
                 .groupBy("session_id", "block").count().filter("session_id = 'hot'"))
        held = [len(p) for p in first.rdd.glom().collect()]
        assert sum(held) == 10_000 and max(held) < 3_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Python" not in plan
