"""Plan checks: pruning, pushdown, no Python UDFs, no single-task windows."""

import re

import pytest

from eventlens.plans import catalog

SF = "/root/testdata/sf0.001"
BATCH = [n for n in catalog.QUERIES if not n.startswith("stream_")]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_udf(spark, name):
    plan = physical(catalog.QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", BATCH)
def test_no_single_partition_window_except_top_k(spark, name):
    plan = physical(catalog.QUERIES[name](spark, SF))
    if re.search(r"\bWindow \[", plan):
        assert name == "trending_products"
        assert "TakeOrderedAndProject" in plan  # the window sees the k survivors only


def test_events_by_type_reads_one_column(spark):
    plan = physical(catalog.QUERIES["events_by_type"](spark, SF))
    assert "ReadSchema: struct<event_type:string>" in plan


def test_top_k_and_preview_are_take_ordered(spark):
    for name in ("trending_products", "lake_preview"):
        assert "TakeOrderedAndProject" in physical(catalog.QUERIES[name](spark, SF))


def test_lake_day_slice_prunes_partitions(spark):
    plan = physical(catalog.QUERIES["lake_day_slice"](spark, SF))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_counts_aggregate_partially_before_shuffle(spark):
    plan = physical(catalog.QUERIES["product_window_counts_60s"](spark, SF))
    assert "partial_count" in plan
