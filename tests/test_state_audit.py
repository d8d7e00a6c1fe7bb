"""The state of A1 read back from its checkpoint."""

import datetime as dt
import time

from eventlens.functions.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA, nullable
from eventlens.sinks.serving import ServingTable
from eventlens.streaming import jobs


def ev(spark, times):
    data = [(f"e{i}", t, "u", "a", "s", "purchase", "p", None, None, None, None if i % 2 else "P", "{}", t)
            for i, t in enumerate(times)]
    return spark.createDataFrame(data, nullable(CONTRACT_SCHEMA)).select(*CONTRACT_COLUMNS)


def test_open_windows_agree_with_the_served_rows(spark, tmp_dir):
    t = [dt.datetime(2024, 1, 1, 10, m) for m in (0, 0, 0, 1, 1, 30, 30, 31)]
    table = ServingTable(f"{tmp_dir}/served", jobs.PRODUCT_COUNT_KEYS)
    for part in (t[:4], t[4:]):
        ev(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        time.sleep(0.05)
    jobs.drain(jobs.serve(jobs.speed_layer(jobs.file_event_stream(spark, f"{tmp_dir}/in", 1), "2 minutes"), table,
                          f"{tmp_dir}/ck", state_partitions=2, conf={"spark.sql.streaming.noDataMicroBatches.enabled": "true"}))
    rows = jobs.state_differences(spark, f"{tmp_dir}/ck", table).collect()
    assert {(r.product_id, r.window_end.minute) for r in rows} == {("P", 31), ("PROD_GENERAL", 31), ("PROD_GENERAL", 32)}
    assert all(r.state_count == r.served_count for r in rows)
    assert len(table.read(spark).collect()) > len(rows)  # passed windows are served, not held

    # a served row that is lost or wrong shows
    some = rows[0]
    bad = ServingTable(f"{tmp_dir}/bad", jobs.PRODUCT_COUNT_KEYS)
    bad.upsert(table.read(spark).filter(f"NOT (product_id = '{some.product_id}' AND window_end = TIMESTAMP '{some.window_end}')"), 0)
    lost = jobs.state_differences(spark, f"{tmp_dir}/ck", bad).filter("served_count IS NULL").collect()
    assert [(r.product_id, r.window_end) for r in lost] == [(some.product_id, some.window_end)]
