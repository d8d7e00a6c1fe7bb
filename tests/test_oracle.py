"""Every named query against its DuckDB oracle, as the driver compares them."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E
from eventlens.plans.catalog import QUERIES  # noqa: E402
from check_oracle import digest, duck  # noqa: E402

SF = os.environ.get("EVENTLENS_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_type", "product_id", "window_start", "window_end", "event_count"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_canonical_messages_shape(spark):
    import json
    rows = E.queries()["canonical_messages"](spark, "/root/testdata/sf0.001").limit(50).collect()
    for r in rows:
        body = json.loads(r.value)
        assert set(body) == {"event_id", "timestamp", "user_id", "anonymous_id", "session_id", "event_type",
                             "page_url", "referrer_url", "device", "price", "product_id", "properties"}
        assert body["timestamp"].endswith("+00:00") and isinstance(body["properties"], dict)
        assert r.key == (body["user_id"] or body["anonymous_id"])
