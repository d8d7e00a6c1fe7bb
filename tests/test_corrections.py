"""Late events end up in the served counts, once, also when a batch runs again."""

import datetime as dt
import time

import pytest

from eventlens.functions.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA, nullable
from eventlens.operators import windows
from eventlens.sinks.serving import ServingTable
from eventlens.streaming import jobs
from eventlens.streaming.corrections import Corrections


def ev(spark, rows):
    data = [(f"e{i}", t, "u", "a", "s", kind, "p", None, None, None, product, "{}", t) for i, (t, kind, product) in enumerate(rows)]
    return spark.createDataFrame(data, nullable(CONTRACT_SCHEMA)).select(*CONTRACT_COLUMNS)


def at(day, minute):
    return dt.datetime(2024, 1, day, 10, minute)


BATCHES = [
    [(at(1, m), "click", "P") for m in range(10)] + [(at(1, 0), "click", None), (None, "click", "P")],
    [(at(5, m), "view", "Q") for m in range(5)],
    [(at(9, 1), "view", "Q")],
    [(at(1, 0), "click", "P")] * 3 + [(at(1, 3), "click", ""), (at(9, 1), "view", "Q"), (at(2, 0), "view", "new")],
    [(at(1, 0), "click", "P")] * 2 + [(at(10, 0), "view", "Q")],
    [(at(9, 1), "view", "Q")] * 4,
]


def files(spark, folder, batches=BATCHES):
    for rows in batches:
        ev(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    return folder


def want(spark, batches=BATCHES, window="60 seconds"):
    every = ev(spark, [r for b in batches for r in b])
    return sorted(map(tuple, windows.serving_projection(windows.product_window_counts(every, window)).collect()))


@pytest.mark.parametrize("window", ["60 seconds", "1 day"])
def test_served_counts_hold_late_events(spark, tmp_dir, window):
    src = files(spark, f"{tmp_dir}/in")
    served = ServingTable(f"{tmp_dir}/served", jobs.PRODUCT_COUNT_KEYS)
    fixed = Corrections(f"{tmp_dir}/fixed", window)
    jobs.drain(jobs.serve(jobs.speed_layer(jobs.file_event_stream(spark, src, 1), "1 minute", window), served, f"{tmp_dir}/c1"),
               fixed.start(jobs.file_event_stream(spark, src, 1), f"{tmp_dir}/c2"))
    lost = sorted(map(tuple, served.read(spark).collect()))
    got = fixed.read(spark, served)
    assert got.columns == ["event_type", "window_end", "product_id", "event_count"]
    assert sorted(map(tuple, got.collect())) == want(spark, window=window) != lost


def test_a_retried_batch_counts_once(spark, tmp_dir):
    """The batch fails after all is written, and again after half of it; the restarted query runs it anew."""
    src = files(spark, f"{tmp_dir}/in")
    served = ServingTable(f"{tmp_dir}/served", jobs.PRODUCT_COUNT_KEYS)
    jobs.drain(jobs.serve(jobs.speed_layer(jobs.file_event_stream(spark, src, 1), "1 minute"), served, f"{tmp_dir}/c1"))
    fixed = Corrections(f"{tmp_dir}/fixed")
    done, upsert, failures = fixed.fold, fixed.table.upsert, []

    def after_all(batch, batch_id):
        done(batch, batch_id)
        if batch_id == 3 and len(failures) < 1:
            failures.append("all")
            raise RuntimeError("lost")

    def half(batch, batch_id):
        upsert(batch, batch_id)
        if batch_id == 4 and len(failures) < 2:
            failures.append("half")
            raise RuntimeError("lost")

    fixed.fold, fixed.table.upsert = after_all, half
    for _ in range(3):
        q = fixed.start(jobs.file_event_stream(spark, src, 1), f"{tmp_dir}/c2")
        try:
            jobs.drain(q)
        except Exception:
            continue
    assert failures == ["all", "half"]
    assert sorted(map(tuple, fixed.read(spark, served).collect())) == want(spark)


def test_only_touched_hours_are_read(spark, tmp_dir):
    fixed = Corrections(f"{tmp_dir}/fixed")
    for i, rows in enumerate(BATCHES[:4]):
        fixed.fold(ev(spark, rows), i)
    rows = fixed.table.read(spark).collect()
    assert {(r.event_type, r.product_id, r.window_end.day) for r in rows} == {
        ("click", "P", 1), ("click", "PROD_GENERAL", 1), ("view", "new", 2)}
    assert {r.event_count for r in rows if r.product_id == "P"} == {4}


def test_before_any_batch_the_served_rows_stand(spark, tmp_dir):
    served = ServingTable(f"{tmp_dir}/served", jobs.PRODUCT_COUNT_KEYS)
    counts = windows.serving_projection(windows.product_window_counts(ev(spark, BATCHES[0])))
    served.upsert(counts, 0)
    assert Corrections(f"{tmp_dir}/none").read(spark, served).count() == counts.count()
