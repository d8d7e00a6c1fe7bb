"""G2 on a stream: visits by session windows come out once, when they are over, and leave no state."""

import datetime as dt
import time

from eventlens.functions.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA, nullable
from eventlens.operators.funnel import abandoned_visits
from eventlens.sinks.serving import ServingTable
from eventlens.streaming import jobs

T0 = dt.datetime(2024, 1, 1, 10)


def ev(spark, rows):
    data = [(f"e{i}", t, "u", "a", s, kind, "p", None, None, None, "P", "{}", t) for i, (s, m, kind) in enumerate(rows)
            for t in [None if m is None else T0 + dt.timedelta(minutes=m)]]
    return spark.createDataFrame(data, nullable(CONTRACT_SCHEMA)).select(*CONTRACT_COLUMNS)


ROWS = [("left", 0, "view_item"), ("left", 5, "add_to_cart"), ("left", 35, "view_item"),  # 30 minutes apart: one visit
        ("bought", 0, "add_to_cart"), ("bought", 20, "purchase"),
        ("again", 0, "purchase"), ("again", 10, "add_to_cart"), ("again", 10, "add_to_cart"),
        ("tie", 3, "add_to_cart"), ("tie", 3, "purchase"),
        ("twice", 0, "add_to_cart"), ("twice", 31, "purchase"),  # the purchase is another visit's
        ("viewed", 1, "view_item"), (None, 1, "add_to_cart"), ("timeless", None, "add_to_cart")]
WANT = {("left", 0, 5, 35, 1), ("again", 0, 10, 10, 2), ("twice", 0, 0, 0, 1)}


def brute(rows, idle=30):
    by = {}
    for s, m, kind in rows:
        if s is not None and m is not None:
            by.setdefault(s, []).append((m, kind))
    out = set()
    for s, seen in by.items():
        visits = []
        for m, kind in sorted(seen):
            if not visits or m - visits[-1][-1][0] > idle:
                visits.append([])
            visits[-1].append((m, kind))
        for v in visits:
            carts, bought = [m for m, k in v if k == "add_to_cart"], [m for m, k in v if k == "purchase"]
            if carts and (not bought or max(bought) < max(carts)):
                out.add((s, v[0][0], max(carts), v[-1][0], len(carts)))
    return out


def minutes(df):
    found = [(r.session_id, *[int((t - T0).total_seconds() // 60) for t in (r.visit_start, r.last_cart_at, r.last_event_at)],
              r.cart_events) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_batch(spark):
    assert minutes(abandoned_visits(ev(spark, ROWS))) == WANT == brute(ROWS)
    assert abandoned_visits(ev(spark, [])).count() == 0


def test_a_hot_session(spark):
    rows = [("hot", m // 50, "add_to_cart" if m % 7 else "view_item") for m in range(2000)] + \
           [(f"s{m}", m, "add_to_cart") for m in range(300)]
    assert minutes(abandoned_visits(ev(spark, rows).repartition(8))) == brute(rows)


def run(spark, tmp_dir, batches, restart=False):
    table = ServingTable(f"{tmp_dir}/served", jobs.VISIT_KEYS)
    for n, rows in enumerate(batches):
        ev(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        time.sleep(0.05)
        if restart or n == len(batches) - 1:
            q = jobs.serve_abandoned_visits(jobs.file_event_stream(spark, f"{tmp_dir}/in", 1), table, f"{tmp_dir}/ck",
                                            "10 minutes", state_partitions=2)
            jobs.drain(q)
    return minutes(table.read(spark)), q


def test_stream_over_batches_and_restarts(spark, tmp_dir):
    """A visit goes on over batches and restarts; open visits aren't served; state goes with the visit."""
    batches = [ROWS, [("left", 38, "view_item")], [("end", 200, "add_to_cart")], [("end", 229, "view_item")]]
    got, q = run(spark, tmp_dir, batches, restart=True)
    want = {v for v in brute([r for b in batches for r in b]) if v[3] + 30 <= 229 - 10}
    assert got == want and ("left", 0, 5, 38, 1) in got and not any(v[0] == "end" for v in got)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1  # the visit that may go on
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "false"  # the session's value is back


def test_a_failed_write_is_served_once(spark, tmp_dir):
    table = ServingTable(f"{tmp_dir}/served", jobs.VISIT_KEYS)
    for rows in (ROWS, [("end", 300, "view_item")]):
        ev(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        time.sleep(0.05)
    failed = []

    def write(batch, batch_id):
        table.upsert(batch, batch_id)
        if not failed and batch.count():
            failed.append(batch_id)
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            jobs.drain(jobs.serve_abandoned_visits(jobs.file_event_stream(spark, f"{tmp_dir}/in", 1), table, f"{tmp_dir}/ck",
                                                   "10 minutes", state_partitions=2, write=write))
        except Exception:
            continue
    assert failed and minutes(table.read(spark)) == WANT
