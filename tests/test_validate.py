"""Strict contract validation (P1-P9), modelled on the reference's contract tests."""

import json

import pytest
from pyspark.sql import functions as F

from eventlens.operators.validate import accepted, rejected, validate_json

VALID = {  # a valid product view
    "user_id": "u_1", "anonymous_id": "anon_1", "session_id": "s_1",
    "event_type": "product_view", "page_url": "https://shop.example.com/p/1",
    "product_id": "P1", "price": 99.99,
}


def check(spark, *payloads):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = validate_json(df).collect()
    return rows


def test_valid_event_accepted_with_defaults(spark):
    (r,) = check(spark, VALID)
    assert r.is_valid and r.reasons == []
    assert r.price == pytest.approx(99.99)
    assert r.properties == "{}"
    assert sorted(r.defaulted) == ["event_id", "properties", "timestamp"]
    assert len(r.event_id) == 36 and r.event_id.count("-") == 4
    assert r.timestamp is not None


def test_invalid_event_rejected_with_all_reasons(spark):
    (r,) = check(spark, {"event_type": "page_view"})  # F3
    assert not r.is_valid
    assert set(r.reasons) == {"anonymous_id:missing", "session_id:missing", "page_url:missing",
                              "event_type:not_allowed"}


def test_probe_message_rejected(spark):
    probe = {"event_id": "e1", "user_id": "u", "anonymous_id": "a", "session_id": "s",
             "event_type": "test_probe", "timestamp": "2026-10-02T10:00:00Z"}  # F4
    (r,) = check(spark, probe)
    assert set(r.reasons) == {"page_url:missing", "event_type:not_allowed"}


def test_all_enum_values_accepted_and_not_folded(spark):
    types = ["view_item", "add_to_cart", "checkout", "purchase", "product_view", "VIEW_ITEM", " purchase"]
    rows = check(spark, *[{**VALID, "event_type": t} for t in types])
    assert [r.is_valid for r in rows] == [True] * 5 + [False, False]


def test_strip_root_strings_not_device(spark):
    ev = {**VALID, "anonymous_id": " \tanon\n ", "device": {"os": " iOS ", "extra": 1}}
    (r,) = check(spark, ev)
    assert r.is_valid and r.anonymous_id == "anon"
    assert r.device.os == " iOS "
    assert "extra" not in r.device.asDict()


def test_number_not_coerced_to_string(spark):
    (r,) = check(spark, {**VALID, "user_id": 123})
    assert r.reasons == ["user_id:not_a_string"]


def test_price_string_coerced(spark):
    good, bad = check(spark, {**VALID, "price": "12.5"}, {**VALID, "price": "abc"})
    assert good.is_valid and good.price == 12.5
    assert bad.reasons == ["price:not_a_number"]


def test_absent_versus_null(spark):
    rows = check(spark, {**VALID, "event_id": None}, {**VALID, "timestamp": None},
                 {**VALID, "properties": None}, {**VALID, "user_id": None})
    assert rows[0].reasons == ["event_id:null"]
    assert rows[1].reasons == ["timestamp:null"]
    assert rows[2].reasons == ["properties:null"]
    assert rows[3].is_valid and rows[3].user_id is None


def test_malformed_and_scalar(spark):
    a, b, c = check(spark, "{bad", "42", '"text"')
    assert a.reasons == ["malformed_json"]
    assert b.reasons == ["not_an_object"] and c.reasons == ["not_an_object"]


def test_timestamps(spark):
    rows = check(spark, {**VALID, "timestamp": "2026-10-02T10:00:00Z"},
                 {**VALID, "timestamp": "2026-10-02T12:00:00+02:00"},
                 {**VALID, "timestamp": 1791000000},
                 {**VALID, "timestamp": "yesterday"},
                 {**VALID, "timestamp": "2026-10-02t10:00:00z"},
                 {**VALID, "timestamp": "2026-10-02_10:00:00"},
                 {**VALID, "timestamp": "2026-10-02"},
                 {**VALID, "timestamp": "1791000000"},
                 {**VALID, "timestamp": 1791000000000})
    assert str(rows[0].timestamp) == "2026-10-02 10:00:00"
    assert str(rows[1].timestamp) == "2026-10-02 10:00:00"  # converted to UTC
    assert rows[2].is_valid
    assert rows[3].reasons == ["timestamp:invalid"]
    assert [str(r.timestamp) for r in rows[4:7]] == ["2026-10-02 10:00:00", "2026-10-02 10:00:00",
                                                     "2026-10-02 00:00:00"]
    assert rows[7].timestamp == rows[2].timestamp == rows[8].timestamp  # text, seconds and ms agree


def test_undeclared_fields_dropped_and_properties_kept(spark):
    (r,) = check(spark, {**VALID, "email": "x@y.z", "properties": {"q": 2, "n": {"a": [1]}}})
    assert r.is_valid
    assert json.loads(r.properties) == {"q": 2, "n": {"a": [1]}}


def test_split_accepted_rejected(spark):
    df = spark.createDataFrame([(json.dumps(VALID),), ("{bad",)], "value string")
    v = validate_json(df)
    assert accepted(v).count() == 1
    rej = rejected(v).collect()
    assert len(rej) == 1 and rej[0].raw == "{bad" and rej[0].reasons == ["malformed_json"]


def test_missing_event_id_is_replay_stable(spark):
    text = json.dumps(VALID)
    a, b = check(spark, text, text)
    assert a.event_id == b.event_id


def test_routing_key(spark):
    from eventlens.functions.text import routing_key
    df = spark.createDataFrame([("u1", "a1"), ("", "a2"), (None, "a3")], "user_id string, anonymous_id string")
    assert [r[0] for r in df.select(routing_key()).collect()] == ["u1", "a2", "a3"]


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(json.dumps(VALID),)], "value string")
    plan = validate_json(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filter_not_pushed_below_parse(spark):
    df = spark.createDataFrame([(json.dumps(VALID),)], "value string")
    plan = validate_json(df).filter("is_valid")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1
