"""G1 / G2 / G4 and the Kafka option builders."""

import datetime as dt
import json

from pyspark.sql import functions as F

from eventlens.functions.contract import CONTRACT_SCHEMA
from eventlens.operators import funnel
from eventlens.sinks.topic import PRODUCER_OPTIONS, canonical_message
from eventlens.sources.kafka import records_to_messages, topic_options


def ev(spark, rows):
    data = []
    for sess, minute, etype, ref in rows:
        ts = dt.datetime(2024, 1, 1, 10, minute)
        data.append((f"{sess}-{minute}-{etype}", ts, "u", "a", sess, etype, "p", ref, None, None, "P", "{}", ts))
    return spark.createDataFrame(data, CONTRACT_SCHEMA)


def test_funnel_needs_order(spark):
    df = ev(spark, [
        ("s1", 1, "product_view", None), ("s1", 2, "add_to_cart", None), ("s1", 3, "checkout", None),
        ("s1", 4, "purchase", None),
        ("s2", 5, "add_to_cart", None), ("s2", 6, "view_item", None),   # cart before view: depth 1
        ("s3", 1, "view_item", None), ("s3", 2, "add_to_cart", None),
    ])
    got = {r.step: r.sessions for r in funnel.conversion_funnel(df).collect()}
    assert got == {"view": 3, "add_to_cart": 2, "checkout": 1, "purchase": 1}


def test_abandoned_carts(spark):
    df = ev(spark, [
        ("s1", 1, "add_to_cart", None), ("s1", 2, "purchase", None),     # bought
        ("s2", 1, "add_to_cart", None), ("s2", 9, "view_item", None),    # abandoned
        ("s3", 3, "purchase", None), ("s3", 4, "add_to_cart", None),     # cart after the purchase
        ("s4", 50, "add_to_cart", None),                                 # not idle long enough
    ])
    as_of = F.lit(dt.datetime(2024, 1, 1, 11, 0)).cast("timestamp")
    got = sorted(r.session_id for r in funnel.abandoned_carts(df, "30 minutes", as_of).collect())
    assert got == ["s2", "s3"]


def test_referrer_hosts(spark):
    df = ev(spark, [("s1", 1, "view_item", "https://www.Google.com/search?q=x"),
                    ("s1", 2, "view_item", None), ("s2", 3, "view_item", "not a url")])
    got = {r.referrer_host: (r.event_count, r.sessions) for r in funnel.traffic_by_referrer(df).collect()}
    assert got == {"www.google.com": (1, 1), "(direct)": (2, 2)}


def test_topic_options():
    speed = topic_options("b:9092", starting="latest")
    archive = topic_options("b:9092", starting="earliest", min_offsets=5000, max_trigger_delay="60s")
    assert speed["startingOffsets"] == "latest" and speed["subscribe"] == "events.clickstream.raw"
    assert archive["minOffsetsPerTrigger"] == "5000" and archive["maxTriggerDelay"] == "60s"
    assert PRODUCER_OPTIONS["kafka.acks"] == "all"


def test_records_to_messages(spark):
    rec = spark.createDataFrame([(b"k", b'{"a":1}', dt.datetime(2024, 1, 1))],
                                "key binary, value binary, timestamp timestamp")
    (r,) = records_to_messages(rec).collect()
    assert r.value == '{"a":1}' and r.key == "k" and r.arrival_ts == dt.datetime(2024, 1, 1)


def test_canonical_message_keeps_nulls(spark):
    df = ev(spark, [("s1", 1, "view_item", None)]).withColumn("user_id", F.lit(None).cast("string"))
    (r,) = canonical_message(df).collect()
    body = json.loads(r.value)
    assert body["user_id"] is None and body["referrer_url"] is None and body["properties"] == {}
    assert body["timestamp"] == "2024-01-01T10:01:00+00:00"
    assert r.key == "a"
