"""A6 / A7 / K1 in bounded space: estimates within their bound of exact counts, and a proved top k."""

import datetime as dt

from pyspark.sql import functions as F

from eventlens.operators import sketches
from eventlens.operators.metrics import trending_products

T0 = "TIMESTAMP '2024-01-01 00:00:00'"


def events(spark, n=200_000, users=60_000, days=10):
    return spark.range(n).select(
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(users)).cast("string"))).alias("user_id"),
        F.concat(F.lit("s"), (F.col("id") % 500).cast("string")).alias("session_id"),
        F.when(F.col("id") % 1000 != 3, F.expr(f"{T0} + make_interval(0, 0, 0, 0, 0, 0, id * {days * 86400} DIV {n})")).alias("timestamp"))


def test_ranges_are_within_the_bound(spark):
    ev = events(spark, users=120_000)
    got = {r.range_start: r for r in sketches.distinct_in_ranges(sketches.hourly_sketches(ev), "3 days").collect()}
    want = {r.range_start: r.unique_users for r in sketches.distinct_in_ranges_exact(ev, "3 days").collect()}
    assert set(got) == set(want) and max(want.values()) > 10 * 4096
    for start, exact in want.items():
        assert abs(got[start].users_estimate - exact) <= sketches.relative_error() * exact
        assert got[start].sessions_estimate == 500  # few values: counted exactly
    wider = {r.range_start: r.users_estimate for r in sketches.distinct_in_ranges(
        sketches.hourly_sketches(ev, lg_entries=16), "3 days", lg_entries=16).collect()}
    assert all(abs(wider[s] - n) <= sketches.relative_error(16) * n for s, n in want.items())


def test_any_range_without_its_events(spark, tmp_dir):
    ev = events(spark, 30_000, 3_000)
    sketches.hourly_sketches(ev).write.parquet(f"{tmp_dir}/s")
    stored = spark.read.parquet(f"{tmp_dir}/s")
    lo, hi = dt.datetime(2024, 1, 2, 5), dt.datetime(2024, 1, 4, 7)
    one = sketches.distinct_between(stored, lo, hi).first()
    rows = ev.filter((F.col("timestamp") >= F.lit(lo)) & (F.col("timestamp") < F.lit(hi)))
    assert one.users_estimate == rows.agg(F.count_distinct("user_id")).first()[0]
    none = sketches.distinct_between(stored, dt.datetime(2030, 1, 1), dt.datetime(2031, 1, 1)).first()
    assert (none.users_estimate, none.sessions_estimate) == (0, 0)
    early, late = F.col("hour") < F.lit(lo), F.col("hour") >= F.lit(hi)
    both = sketches.users_in_both(stored, early, late).first()[0]
    t = F.col("timestamp")
    want = (ev.filter(t < F.lit(lo)).select("user_id").intersect(ev.filter(t >= F.lit(hi)).select("user_id"))
            .filter("user_id IS NOT NULL").count())
    assert both == want > 0
    assert sketches.users_in_both(stored, early, F.lit(False)).first()[0] == 0


def test_no_events(spark):
    ev = events(spark, 0)
    assert sketches.hourly_sketches(ev).count() == 0
    assert sketches.distinct_between(sketches.hourly_sketches(ev), dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)).first() == (0, 0)


def views(spark, counts):
    rows = spark.createDataFrame(list(counts.items()), "product_id string, n int")
    return rows.select("product_id", F.explode(F.sequence(F.lit(1), "n")).alias("i")).select(
        "product_id", F.expr(f"{T0} + make_interval(0, 0, 0, 0, 0, i, 0)").alias("viewed_at"))


def exact(v, k):
    return sorted(map(tuple, trending_products(v.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("view_count"), F.max("viewed_at").alias("last_viewed_at")), k).collect()))


def counted(v, k, tracked):
    """The answer, and whether only candidates were counted for it."""
    got = sketches.trending_bounded(v, k, tracked)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    return sorted(map(tuple, got.collect())), " IN (" in plan or "INSET" in plan


def test_a_hot_head_over_a_long_tail(spark):
    """5,000 products, far more than the summary holds; a third of the views are one product's."""
    counts = {f"tail{i}": 1 + i % 3 for i in range(5_000)} | {f"hot{i}": 900 - 20 * i for i in range(12)} | {"top": 8_000}
    v = views(spark, counts).repartition(8)
    got, bounded = counted(v, 10, 512)
    assert got == exact(v, 10) and bounded


def test_flat_counts_are_counted_whole(spark):
    """No product stands out, so nothing is proved: every product is counted, and the ties come out by id."""
    v = views(spark, {f"p{i}": 2 for i in range(3_000)})
    got, bounded = counted(v, 10, 64)
    assert got == exact(v, 10) and not bounded


def test_few_products_and_none(spark):
    v = views(spark, {"a": 3, "b": 3, "c": 1})
    assert counted(v, 10, 64)[0] == exact(v, 10)
    assert counted(v.limit(0), 10, 64)[0] == []
    assert counted(v.withColumn("product_id", F.lit(None).cast("string")), 10, 64)[0] == []
