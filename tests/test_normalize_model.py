"""CSV normalisation against a plain-Python model of the mapping rules, over a
seeded random corpus (one Spark job for all rows)."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from eventlens.functions.contract import DEFAULT_PAGE_URL_PREFIX
from eventlens.operators.normalize import ALIASES, EVENT_TYPE_MAP, normalize_export

INGEST = dt.datetime(2030, 1, 1)
TYPES = ["view", "page_view", "click", "cart", "add_to_cart", "purchase", "checkout", "product_view",
         " VIEW ", "Purchase", "signup", "", "other"]
TIMES = ["2019-10-01 00:00:07 UTC", "2019-10-01T00:00:07", "2019-10-01T00:00:07Z",
         "2019-10-01T00:00:07+05:00", "2019-10-01 08:30:00-0300", "2019-10-01",
         "2019-10-01T00:00:07.123456", "2019-10-01 23:59", "garbage", "", "  2019-10-02 01:02:03  ",
         "2019-10-01 00:00:07\t UTC"]
USERS = ["", "u1", "  u2 ", "541312140"]
SESSIONS = ["", "s1", "  s2  "]
PRODUCTS = ["", "P1", " P2 "]
PRICES = ["", "1.5", " 2 ", "abc", "1e3", "-0.5", "1_000.5", "1__0", "_1", "inf"]
OUTCOMES = ["", " ok ", "fail"]
EXTRAS = ["", "x", "  y "]


def model_time(raw):
    raw = raw.strip()
    if not raw:
        return INGEST
    clean = raw.replace(" UTC", "").strip()
    try:
        return dt.datetime.fromisoformat(clean).replace(tzinfo=None)
    except ValueError:
        try:
            return dt.datetime.strptime(clean, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return INGEST


def model(row, style):
    def get(field):
        name = ALIASES[field][style]
        return (row.get(name) or "").strip()
    etype = EVENT_TYPE_MAP.get(get("event_type").lower(), "view_item")
    user = get("user") or None
    product = get("product") or "PROD_GENERAL"
    try:
        price = float(get("price")) if get("price") else None
    except ValueError:
        price = None
    props = {}
    if get("outcome"):
        props["outcome"] = get("outcome")
    for extra in ("category_id", "category_code", "brand"):
        if row.get(extra):
            props[extra] = row[extra].strip()
    return {"event_type": etype, "timestamp": model_time(row.get(ALIASES["time"][style]) or ""),
            "user_id": user, "session": get("session") or None, "product_id": product,
            "page_url": DEFAULT_PAGE_URL_PREFIX + product, "price": price, "properties": props}


@pytest.mark.parametrize("seed", [7, 11])
@pytest.mark.parametrize("style", [0, 1])
def test_normalize_matches_model(spark, style, seed):
    rng = random.Random(seed + style)
    fields = ["event_type", "time", "user", "session", "product", "price", "outcome"]
    header = [ALIASES[f][style] for f in fields] + ["category_id", "category_code", "brand"]
    pools = [TYPES, TIMES, USERS, SESSIONS, PRODUCTS, PRICES, OUTCOMES, EXTRAS, EXTRAS, EXTRAS]
    rows = [[rng.choice(p) for p in pools] for _ in range(400)]
    # CSV readers give null for an empty cell
    df = spark.createDataFrame([[v if v != "" else None for v in r] for r in rows],
                               ", ".join(f"`{h}` string" for h in header))
    got = normalize_export(df, ingest_ts=F.lit(INGEST).cast("timestamp")).collect()
    assert len({r.event_id for r in got}) == len(rows)

    def plain(*values):
        *cells, price, props, session = values
        return repr((*cells, price, sorted(props.items()), session))

    want = sorted(plain(w["event_type"], w["timestamp"], w["user_id"], w["product_id"], w["page_url"], w["price"],
                        w["properties"], w["session"]) for w in (model(dict(zip(header, r)), style) for r in rows))
    sessions = {s for s in SESSIONS if s}
    found = sorted(plain(g.event_type, g.timestamp, g.user_id, g.product_id, g.page_url, g.price,
                         json.loads(g.properties),
                         None if g.session_id.startswith("sess_") and g.session_id not in sessions else g.session_id)
                   for g in got)
    bad = [(w, g) for w, g in zip(want, found) if w != g]
    assert not bad, bad[:4]
