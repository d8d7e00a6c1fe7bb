"""Lenient CSV normalisation (N1-N8) and the CSV source."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from eventlens.functions.contract import DEFAULT_PAGE_URL_PREFIX
from eventlens.operators.normalize import normalize_export, resolve_alias
from eventlens.sources.csv_export import read_export

INGEST = dt.datetime(2030, 1, 1, 0, 0, 0)


def norm(spark, header, rows):
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))
    return normalize_export(df, ingest_ts=F.lit(INGEST).cast("timestamp")).collect()


def test_snake_case_export(spark):
    header = ["event_time", "event_type", "product_id", "category_id", "category_code", "brand",
              "price", "user_id", "user_session"]
    (r,) = norm(spark, header, [("2019-10-01 00:00:07 UTC", "cart", "44600062", "2103807459595387724",
                                 None, " shiseido ", "35.79", "541312140", "72d76fde")])
    assert r.event_type == "add_to_cart"
    assert r.timestamp == dt.datetime(2019, 10, 1, 0, 0, 7)
    assert r.product_id == "44600062" and r.page_url == DEFAULT_PAGE_URL_PREFIX + "44600062"
    assert r.price == 35.79 and r.user_id == "541312140" and r.session_id == "72d76fde"
    assert r.anonymous_id == "anon_541312140"
    assert json.loads(r.properties) == {"category_id": "2103807459595387724", "brand": "shiseido"}


def test_capitalised_export_and_defaults(spark):
    header = ["EventType", "Timestamp", "UserID", "SessionID", "ProductID", "Amount", "Outcome"]
    rows = norm(spark, header, [
        ("PAGE_VIEW", "2024-03-01T10:00:00+05:00", "", "", "", "abc", " ok "),
        ("something", "not a time", "u1", "s1", "P9", " 1.5 ", None),
        ("Purchase", None, None, None, None, None, None),
    ])
    a, b, c = rows
    assert a.event_type == "view_item"
    assert a.timestamp == dt.datetime(2024, 3, 1, 10, 0, 0)  # offset dropped, not applied
    assert a.user_id is None and a.session_id.startswith("sess_") and len(a.session_id) == 17
    assert a.anonymous_id == "anon_" + a.session_id
    assert a.product_id == "PROD_GENERAL" and a.price is None
    assert json.loads(a.properties) == {"outcome": "ok"}
    assert b.event_type == "view_item" and b.timestamp == INGEST and b.price == 1.5
    assert c.event_type == "purchase" and c.timestamp == INGEST and json.loads(c.properties) == {}


def test_session_fallback_and_id_are_replay_stable(spark):
    header = ["event_type", "event_time", "user_id"]
    cells = [("view", "2024-01-01 00:00:00", "u"), ("view", "2024-01-01 00:00:00", "u")]
    first, again = (sorted((r.session_id, r.event_id) for r in norm(spark, header, cells)) for _ in range(2))
    assert first == again and len(set(first)) == 2  # equal rows are events of their own, on every replay the same


def test_alias_order():
    assert resolve_alias(["event_type", "EventType"], "event_type") == "EventType"
    assert resolve_alias(["user_session"], "session") == "user_session"
    assert resolve_alias(["x"], "price") is None


def test_csv_with_bom_and_unknown_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "export.csv")
    with open(path, "wb") as f:  # a small export with unrelated columns
        f.write("﻿EVENT_ID,STATUS,TIMESTAMP\n1,ok,2026-10-02\n".encode("utf-8"))
    raw = read_export(spark, path)
    assert raw.columns == ["EVENT_ID", "STATUS", "TIMESTAMP"]
    (r,) = normalize_export(raw, ingest_ts=F.lit(INGEST).cast("timestamp")).collect()
    assert r.event_type == "view_item" and r.product_id == "PROD_GENERAL" and r.timestamp == INGEST
