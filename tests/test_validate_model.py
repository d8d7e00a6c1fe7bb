"""The strict validator against a plain-Python model of the contract rules,
over a seeded random corpus (one Spark job for all cases)."""

import json
import math
import random
from datetime import datetime

import pytest

from eventlens.functions.contract import DEVICE_FIELDS, EVENT_TYPES
from eventlens.operators.validate import validate_json

ABSENT = object()
WS = " \t\n  "
STRINGS = ["abc", "  padded  ", " nbsp ", "", "x" * 40, "tab\tinside", "ünï"]
NUMBERS = [0, 7, -3, 12.5, 1e3, 99.99]
OTHER = [True, False, [1, 2], {"a": 1}]
TIMES = ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05", "2024-01-02T03:04:05.123456+02:00",
         "2024-01-02", "not a time", "2024-13-40T00:00:00", "1704164645", " 1704164645.5 "]
PRICES_TEXT = ["12.5", " 3 ", "1e2", "abc", "", ".5"]


def pick(rng, pool_weights):
    pools, weights = zip(*pool_weights)
    pool = rng.choices(pools, weights)[0]
    return pool if pool is ABSENT or pool is None else rng.choice(pool)


def payload(rng):
    d = {}
    def put(name, value):
        if value is not ABSENT:
            d[name] = value
    put("event_id", pick(rng, [(ABSENT, 2), (None, 1), (STRINGS, 6), (NUMBERS, 1)]))
    put("timestamp", pick(rng, [(ABSENT, 2), (None, 1), (TIMES, 6), ([1704164645], 1), (OTHER, 1)]))
    for name in ("anonymous_id", "session_id", "page_url"):
        put(name, pick(rng, [(ABSENT, 1), (None, 1), (STRINGS, 10), (NUMBERS, 1)]))
    put("event_type", pick(rng, [(ABSENT, 1), (None, 1), (list(EVENT_TYPES), 10),
                                 (["page_view", " purchase", "PURCHASE"], 2), (NUMBERS, 1)]))
    for name in ("user_id", "referrer_url", "product_id"):
        put(name, pick(rng, [(ABSENT, 3), (None, 2), (STRINGS, 6), (NUMBERS, 1)]))
    put("price", pick(rng, [(ABSENT, 3), (None, 1), (NUMBERS, 4), (PRICES_TEXT, 3), ([[1], {"p": 1}], 1)]))
    if rng.random() < 0.5:
        if rng.random() < 0.15:
            d["device"] = rng.choice(["ios", 3, [1]])
        elif rng.random() < 0.1:
            d["device"] = None
        else:
            dev = {}
            for f in DEVICE_FIELDS:
                v = pick(rng, [(ABSENT, 2), (None, 1), (STRINGS, 6), (NUMBERS, 1)])
                if v is not ABSENT:
                    dev[f] = v
            dev["extra"] = "dropped"
            d["device"] = dev
    put("properties", pick(rng, [(ABSENT, 2), (None, 1), ([{"a": 1}, {"n": {"b": [1, None]}}, {}], 6),
                                 (["text", [1]], 1)]))
    if rng.random() < 0.2:
        d["undeclared"] = "pii"
    return d


def is_num(v):
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def model(text):
    """Expected (reasons set, key values) following the contract rules."""
    try:
        doc = json.loads(text)
    except ValueError:
        return {"malformed_json"}, None
    if not isinstance(doc, dict):
        return {"not_an_object"}, None
    r = set()
    get = lambda k: doc.get(k, ABSENT)
    for n in ("anonymous_id", "session_id", "event_type", "page_url"):
        v = get(n)
        if v is ABSENT:
            r.add(f"{n}:missing")
        elif v is None:
            r.add(f"{n}:null")
        elif not isinstance(v, str):
            r.add(f"{n}:not_a_string")
        elif n == "event_type" and v not in EVENT_TYPES:
            r.add("event_type:not_allowed")
    for n in ("user_id", "referrer_url", "product_id"):
        v = get(n)
        if v not in (ABSENT, None) and not isinstance(v, str):
            r.add(f"{n}:not_a_string")
    v = get("event_id")
    if v is None:
        r.add("event_id:null")
    elif v is not ABSENT and not isinstance(v, str):
        r.add("event_id:not_a_string")
    v = get("timestamp")
    if v is None:
        r.add("timestamp:null")
    elif v is not ABSENT:
        ok = is_num(v)
        if isinstance(v, str):
            try:
                datetime.fromisoformat(v.strip().replace("Z", "+00:00"))
                ok = True
            except ValueError:
                try:
                    float(v.strip())
                    ok = "_" not in v and v.strip().lower() not in ("nan", "inf", "-inf", "infinity")
                except ValueError:
                    ok = False
        if not ok:
            r.add("timestamp:invalid")
    v = get("price")
    price = None
    if v not in (ABSENT, None):
        if is_num(v) or isinstance(v, bool):
            price = float(v)
        elif isinstance(v, str):
            try:
                price = float(v.strip(WS))
            except ValueError:
                price = None
        if price is None:
            r.add("price:not_a_number")
    v = get("device")
    if v not in (ABSENT, None):
        if not isinstance(v, dict):
            r.add("device:not_an_object")
        else:
            for f in DEVICE_FIELDS:
                x = v.get(f, ABSENT)
                if x not in (ABSENT, None) and not isinstance(x, str):
                    r.add(f"device.{f}:not_a_string")
    v = get("properties")
    if v is None:
        r.add("properties:null")
    elif v is not ABSENT and not isinstance(v, dict):
        r.add("properties:not_an_object")
    strip = lambda x: x.strip() if isinstance(x, str) else None
    values = {
        "anonymous_id": strip(get("anonymous_id")),
        "user_id": strip(get("user_id")),
        "price": price,
        "properties": get("properties") if isinstance(get("properties"), dict) else
        ({} if get("properties") is ABSENT else None),
    }
    return r, values


@pytest.fixture(scope="module", params=[20240101, 1])
def corpus(request):
    rng = random.Random(request.param)
    texts = [json.dumps(payload(rng)) for _ in range(600)]
    texts += ["{bad", "[1, 2]", "42", '"s"', "null", "", "{\"a\": }"]
    return texts


def test_validator_matches_model(spark, corpus):
    df = spark.createDataFrame([(t,) for t in corpus], "value string")
    rows = {r.raw: r for r in validate_json(df).collect()}
    assert len(rows) == len(set(corpus))
    corpus = list(dict.fromkeys(corpus))
    mismatches = []
    for text in corpus:
        want, values = model(text)
        got = rows[text]
        if set(got.reasons) != want or got.is_valid != (not want):
            mismatches.append((text, sorted(want), got.reasons))
            continue
        if values is not None:
            if got.anonymous_id != values["anonymous_id"] or got.user_id != values["user_id"]:
                mismatches.append((text, "strings", got.anonymous_id, got.user_id))
            if values["price"] is not None and not math.isclose(got.price, values["price"]):
                mismatches.append((text, "price", got.price))
            if values["properties"] is not None and json.loads(got.properties) != values["properties"]:
                mismatches.append((text, "properties", got.properties))
    assert not mismatches, mismatches[:5]
    valid = sum(1 for r in rows.values() if r.is_valid)
    assert 20 < valid < len(corpus)  # the corpus exercises both outcomes
