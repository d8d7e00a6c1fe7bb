"""Window counts and metrics (A1-A8, K1-K3, W1, W10, G3) on literal events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlens.functions.contract import CONTRACT_SCHEMA
from eventlens.operators import metrics, windows


def events(spark, rows):
    """rows: (id, 'HH:MM:SS' on 2024-01-01, type, product, user)."""
    data = []
    for eid, hms, etype, product, user in rows:
        ts = dt.datetime.fromisoformat(f"2024-01-01T{hms}")
        data.append((str(eid), ts, user, "anon", f"s_{user}", etype, "u", None, None, 1.0, product, "{}", ts))
    return spark.createDataFrame(data, CONTRACT_SCHEMA)


@pytest.fixture(scope="module")
def ev(spark):
    return events(spark, [
        (1, "00:00:01", "product_view", "P1", "a"),
        (2, "00:00:59", "product_view", "P1", "b"),
        (3, "00:01:00", "product_view", "P1", "a"),
        (4, "00:00:30", "product_view", None, None),
        (5, "00:00:31", "product_view", "", "a"),
        (6, "00:00:10", "purchase", "P2", "a"),
        (7, "10:00:00", "product_view", "P2", "c"),
    ])


def test_a1_tumbling_60s_epoch_aligned_with_default_product(ev):
    rows = {(r.event_type, r.product_id, str(r.window_start)): r.event_count
            for r in windows.product_window_counts(ev).collect()}
    assert rows[("product_view", "P1", "2024-01-01 00:00:00")] == 2
    assert rows[("product_view", "P1", "2024-01-01 00:01:00")] == 1
    assert rows[("product_view", "PROD_GENERAL", "2024-01-01 00:00:00")] == 2
    assert sum(rows.values()) == 7


def test_a1_served_types(ev):
    served = windows.serving_projection(windows.product_window_counts(ev))
    assert served.columns == ["event_type", "window_end", "product_id", "event_count"]
    assert dict(served.dtypes)["event_count"] == "bigint"


def test_w10_rolling_each_event_in_size_over_slide_windows(ev):
    out = windows.product_window_counts(ev, "60 seconds", slide="30 seconds")
    assert out.agg(F.sum("event_count")).first()[0] == 14


def test_a2_rollup(ev):
    a1 = windows.serving_projection(windows.product_window_counts(ev, "1 day"))
    (r,) = windows.event_window_rollup(a1).filter("event_type = 'product_view'").collect()
    assert r.event_count == 6


def test_a3_stats_ignores_null_users(ev):
    rows = {r.event_type: (r.event_count, r.unique_users)
            for r in windows.event_window_stats(ev, "1 day").collect()}
    assert rows["product_view"] == (6, 3)
    approx = {r.event_type: r.unique_users
              for r in windows.event_window_stats(ev, "1 day", distinct="approx").collect()}
    assert approx["product_view"] == 3


def test_a4_k1_views_and_trending(ev):
    views = {r.product_id: (r.view_count, r.last_viewed_at) for r in metrics.product_views(ev).collect()}
    assert views["P1"][0] == 3 and views["PROD_GENERAL"][0] == 2 and views["P2"][0] == 1
    top = metrics.trending_products(metrics.product_views(ev), 2).collect()
    assert [(r.product_id, r.rank) for r in top] == [("P1", 1), ("PROD_GENERAL", 2)]


def test_trending_ties_share_rank(spark):
    v = spark.createDataFrame([("A", 5), ("B", 5), ("C", 1)], "product_id string, view_count long")
    assert [(r.product_id, r.rank) for r in metrics.trending_products(v, 3).collect()] == \
        [("A", 1), ("B", 1), ("C", 3)]


def test_a5_a6_a7_g3(ev):
    by_type = {r.event_type: r.event_count for r in metrics.events_by_type(ev).collect()}
    assert by_type == {"product_view": 6, "purchase": 1}
    (u,) = metrics.unique_users_sessions(ev).collect()
    assert (u.unique_users, u.unique_sessions) == (3, 4)
    (d,) = metrics.daily_trend(ev).collect()
    assert d.event_count == 7


def test_k2_preview(ev):
    first = metrics.preview(ev, 2).collect()
    assert [r.event_id for r in first] == ["1", "6"]


def test_a8_quality_zero_when_empty(spark):
    empty = spark.createDataFrame([], "is_valid boolean, reasons array<string>")
    (r,) = metrics.ingest_quality(empty).collect()
    assert r.total_events == 0 and r.success_pct == 0.0


def test_epoch_millis(spark):
    from eventlens.functions.time import from_epoch_millis
    (r,) = spark.createDataFrame([(60000,)], "ms long").select(from_epoch_millis("ms").alias("t")).collect()
    assert r.t == dt.datetime(1970, 1, 1, 0, 1)
