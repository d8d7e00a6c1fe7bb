"""Archive (S5, P15), lake scan (S3, P13, P14), inventory (S11), dedup."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from eventlens.operators.dedup import dedup_events
from eventlens.operators.validate import archivable, validate_json
from eventlens.session import local_path
from eventlens.sinks.archive import write_lake
from eventlens.sources.lake import lake_files, lake_inventory, lake_slice, read_lake

CLOCK = dt.datetime(2026, 10, 2, 18, 30, 0)  # F6


def f1_messages(spark, n=100):
    """minimal topic messages that fail the contract."""
    rows = [(json.dumps({"event_id": f"evt_{i}", "user_id": f"user_{i}", "event_type": "click",
                         "timestamp": "2026-10-02T10:00:00Z"}), CLOCK) for i in range(n)]
    return spark.createDataFrame(rows, "value string, arrival_ts timestamp")


def test_archive_accepts_what_contract_rejects(spark, tmp_dir):
    v = validate_json(f1_messages(spark), arrival_col="arrival_ts")
    assert v.filter("is_valid").count() == 0
    root = os.path.join(tmp_dir, "lake")
    write_lake(archivable(v), root)
    back = read_lake(spark, root)
    assert back.count() == 100
    assert set(back.columns) >= {"event_id", "event_type", "year", "month", "day", "hour"}
    # the partition path carries the arrival hour, zero-padded
    files = glob.glob(os.path.join(root, "year=2026", "month=10", "day=02", "hour=18", "*.parquet"))
    assert files
    r = back.select("year", "month", "day", "hour").distinct().collect()
    assert [tuple(x) for x in r] == [(2026, 10, 2, 18)]


def test_partition_pruning_and_full_projection(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lake")
    rows = [(json.dumps({"event_id": f"e{d}", "anonymous_id": "a", "session_id": "s", "event_type": "purchase",
                         "page_url": "u"}), dt.datetime(2024, m, d, 5)) for m in (1, 2) for d in (3, 4, 5)]
    msgs = spark.createDataFrame(rows, "value string, arrival_ts timestamp")
    write_lake(archivable(validate_json(msgs, arrival_col="arrival_ts")), root)
    day4 = lake_slice(spark, root, day=4)
    assert day4.count() == 2  # the 4th of every month
    plan = day4._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    assert len(day4.columns) == 19


def test_inventory_counts_files_rows_bytes(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lake")
    v = validate_json(f1_messages(spark, 30), arrival_col="arrival_ts")
    write_lake(archivable(v), root, partitions=3)
    (r,) = lake_inventory(spark, root).collect()
    files = glob.glob(os.path.join(local_path(root), "year=2026/month=10/day=02/hour=18/*.parquet"))
    assert r.n_rows == 30 and r.n_files == len(files)
    assert r.n_bytes == sum(os.path.getsize(f) for f in files)
    (f,) = lake_files(spark, root).collect()
    assert (f.year, f.month, f.day, f.hour) == (2026, 10, 2, 18)
    assert f.n_files == r.n_files and f.n_bytes == r.n_bytes
    plan = lake_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_dedup_keeps_one_per_id(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("a", 1)], "event_id string, v int")
    out = dedup_events(df)
    assert sorted(r.event_id for r in out.collect()) == ["a", "b"]


def test_partition_parts_zero_padded(spark):
    from eventlens.functions.time import partition_parts
    (r,) = spark.createDataFrame([(dt.datetime(2026, 1, 4, 3),)], "t timestamp") \
        .select(*partition_parts("t")).collect()
    assert (r.year, r.month, r.day, r.hour) == ("2026", "01", "04", "03")


def test_hot_hour_is_split_across_tasks(spark, tmp_dir):
    """A third of all rows in one hour: the range partitioner gives it to
    several tasks (several files) instead of one."""
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        ts = base + (dt.timedelta(minutes=5, microseconds=i) if hot else dt.timedelta(hours=1 + i % 48))
        rows.append((json.dumps({"event_id": f"e{i}", "anonymous_id": "a", "session_id": "s",
                                 "event_type": "purchase", "page_url": "u"}), ts))
    msgs = spark.createDataFrame(rows, "value string, arrival_ts timestamp")
    root = os.path.join(tmp_dir, "lake")
    write_lake(archivable(validate_json(msgs, arrival_col="arrival_ts")), root, partitions=6)
    hot_files = glob.glob(os.path.join(root, "year=2024/month=01/day=01/hour=00/*.parquet"))
    assert len(hot_files) >= 2
    assert read_lake(spark, root).count() == 3000


def test_skewed_product_counts_exact(spark):
    """One product with most rows: counts stay exact (partial aggregation)."""
    from eventlens.operators.windows import product_window_counts
    from eventlens.functions.contract import CONTRACT_SCHEMA
    t = dt.datetime(2024, 1, 1, 0, 0, 1)
    data = [(str(i), t, "u", "a", "s", "product_view", "p", None, None, 1.0,
             "HOT" if i % 10 else f"P{i}", "{}", t) for i in range(5000)]
    df = spark.createDataFrame(data, CONTRACT_SCHEMA).repartition(8)
    got = {r.product_id: r.event_count for r in product_window_counts(df).collect()}
    assert got["HOT"] == 4500 and sum(got.values()) == 5000


def test_time_range_prunes_hour_folders(spark, tmp_dir):
    from eventlens.sources.lake import lake_range
    root = os.path.join(tmp_dir, "lake")
    base = dt.datetime(2024, 1, 1)
    rows = [(json.dumps({"event_id": f"e{i}", "anonymous_id": "a", "session_id": "s", "event_type": "purchase",
                         "page_url": "u"}), base + dt.timedelta(minutes=37 * i)) for i in range(200)]
    msgs = spark.createDataFrame(rows, "value string, arrival_ts timestamp")
    write_lake(archivable(validate_json(msgs, arrival_col="arrival_ts")), root, partitions=4)
    start, end = dt.datetime(2024, 1, 2, 5, 30), dt.datetime(2024, 1, 2, 9, 15)
    got = lake_range(spark, root, start, end)
    want = sum(1 for _, t in rows if start <= t < end)
    assert got.count() == want > 0
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # plan text uncut
    try:
        plan = lake_range(spark, root, start, end)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    partition_filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "make_timestamp" in partition_filters
