"""DuckDB SQL giving the expected answer of each named query.

The SQL repeats the contract derivation of :mod:`eventlens.sources.replay`
(and of the fault / export builders in :mod:`eventlens.plans.derived`)
directly on the ``events`` view, then states each metric plainly.  Column
names and types match the Spark outputs.
"""

from __future__ import annotations

from eventlens.functions.contract import DEFAULT_PAGE_URL_PREFIX, EVENT_TYPES
from eventlens.plans.derived import DEVICE_AGENT, DEVICE_KINDS

_ENUM = ", ".join(f"'{t}'" for t in EVENT_TYPES)

EV = f"""
base AS (
  SELECT event_id AS raw_event_id, user_id AS raw_user_id, event_type AS raw_event_type,
         ts, value, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev AS (
  SELECT raw_event_id, raw_user_id, raw_event_type, k, ts,
         CAST(raw_event_id AS VARCHAR) AS event_id,
         ts AS "timestamp",
         CASE WHEN raw_event_id % 11 = 0 THEN NULL ELSE CAST(raw_user_id AS VARCHAR) END AS user_id,
         'anon_' || CAST(raw_user_id AS VARCHAR) AS anonymous_id,
         'sess_' || CAST(raw_user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
         CASE raw_event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'signup' THEN 'checkout' WHEN 'purchase' THEN 'purchase'
              ELSE raw_event_type END AS event_type,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN ''
              ELSE 'PROD_' || CAST(k AS VARCHAR) END AS product_id,
         value AS price,
         props AS properties
  FROM base),
evp AS (
  SELECT *, coalesce(nullif(product_id, ''), 'PROD_GENERAL') AS product_key,
         '{DEFAULT_PAGE_URL_PREFIX}' || coalesce(nullif(product_id, ''), 'PROD_GENERAL') AS page_url
  FROM ev)"""

_BAD = f"(raw_event_id % 50 IN (0, 1, 2, 3, 7, 9, 10, 12) OR event_type NOT IN ({_ENUM}))"

FLAT = ('event_id, "timestamp", user_id, anonymous_id, session_id, event_type, page_url, '
        'price, product_id, properties')

_SECONDS = {"60s": 60, "1d": 86400}
_ROLL = {"60s": (60, 30), "1d": (86400, 21600)}


def _bucket(seconds: int, col: str = '"timestamp"') -> str:
    return f"time_bucket(INTERVAL {seconds} SECOND, {col})"


def product_window_counts(size: str) -> str:
    s = _SECONDS[size]
    return f"""WITH {EV}
SELECT event_type, product_key AS product_id,
       {_bucket(s)} AS window_start,
       {_bucket(s)} + INTERVAL {s} SECOND AS window_end,
       count(*) AS event_count
FROM evp GROUP BY 1, 2, 3, 4"""


def served_product_counts(size: str) -> str:
    s = _SECONDS[size]
    return f"""WITH {EV}
SELECT event_type, {_bucket(s)} + INTERVAL {s} SECOND AS window_end, product_key AS product_id,
       count(*) AS event_count
FROM evp GROUP BY 1, 2, 3"""


def event_window_rollup(size: str) -> str:
    return f"""WITH a1 AS ({served_product_counts(size)})
SELECT event_type, window_end, CAST(sum(event_count) AS BIGINT) AS event_count
FROM a1 GROUP BY 1, 2"""


def event_window_stats(size: str) -> str:
    s = _SECONDS[size]
    return f"""WITH {EV}
SELECT event_type, {_bucket(s)} AS window_start, {_bucket(s)} + INTERVAL {s} SECOND AS window_end,
       count(*) AS event_count, count(DISTINCT user_id) AS unique_users
FROM evp GROUP BY 1, 2, 3"""


def rolling_counts(size: str) -> str:
    length, slide = _ROLL[size]
    n = length // slide
    return f"""WITH {EV},
starts AS (
  SELECT event_type, product_key,
         {_bucket(slide)} - i * INTERVAL {slide} SECOND AS window_start
  FROM evp, range(0, {n}) r(i))
SELECT event_type, product_key AS product_id, window_start,
       window_start + INTERVAL {length} SECOND AS window_end,
       count(*) AS event_count
FROM starts GROUP BY 1, 2, 3, 4"""


PRODUCT_VIEWS = f"""WITH {EV}
SELECT product_key AS product_id, count(*) AS view_count, max("timestamp") AS last_viewed_at
FROM evp WHERE event_type = 'product_view' GROUP BY 1"""

TRENDING = f"""WITH v AS ({PRODUCT_VIEWS}),
top AS (SELECT * FROM v ORDER BY view_count DESC, product_id LIMIT 10)
SELECT product_id, view_count, last_viewed_at,
       CAST(rank() OVER (ORDER BY view_count DESC) AS INTEGER) AS rank
FROM top"""

EVENTS_BY_TYPE = f"""WITH {EV}
SELECT event_type, count(*) AS event_count FROM evp GROUP BY 1"""

UNIQUE_USERS_SESSIONS = f"""WITH {EV}
SELECT count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions
FROM evp"""

DAILY_TREND = f"""WITH {EV}
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS event_count,
       count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions
FROM evp GROUP BY 1"""

CONVERSION_FUNNEL = f"""WITH {EV},
s AS (
  SELECT session_id,
         min(CASE WHEN event_type IN ('view_item', 'product_view') THEN "timestamp" END) AS t1,
         min(CASE WHEN event_type = 'add_to_cart' THEN "timestamp" END) AS t2,
         min(CASE WHEN event_type = 'checkout' THEN "timestamp" END) AS t3,
         min(CASE WHEN event_type = 'purchase' THEN "timestamp" END) AS t4
  FROM evp GROUP BY 1),
d AS (
  SELECT CASE WHEN t1 IS NULL THEN 0
              WHEN t2 IS NULL OR t2 < t1 THEN 1
              WHEN t3 IS NULL OR t3 < t2 THEN 2
              WHEN t4 IS NULL OR t4 < t3 THEN 3 ELSE 4 END AS depth
  FROM s),
c AS (SELECT count(*) FILTER (WHERE depth >= 1) AS s1, count(*) FILTER (WHERE depth >= 2) AS s2,
             count(*) FILTER (WHERE depth >= 3) AS s3, count(*) FILTER (WHERE depth >= 4) AS s4 FROM d)
SELECT 1 AS step_no, 'view' AS step, s1 AS sessions FROM c
UNION ALL SELECT 2, 'add_to_cart', s2 FROM c
UNION ALL SELECT 3, 'checkout', s3 FROM c
UNION ALL SELECT 4, 'purchase', s4 FROM c"""

def _step(n: int, types: str) -> str:
    """The first time of a step at or after that of the step before."""
    return f"""t{n} AS (
  SELECT e.session_id, min(e."timestamp") AS t FROM evp AS e JOIN t{n - 1} AS p ON e.session_id = p.session_id
  WHERE e.event_type IN ({types}) AND e."timestamp" >= p.t GROUP BY 1)"""


FUNNEL_ORDERED = f"""WITH {EV},
t1 AS (SELECT session_id, min("timestamp") AS t FROM evp WHERE event_type IN ('view_item', 'product_view') GROUP BY 1),
{_step(2, "'add_to_cart'")},
{_step(3, "'checkout'")},
{_step(4, "'purchase'")}
SELECT 1 AS step_no, 'view' AS step, count(*) AS sessions FROM t1
UNION ALL SELECT 2, 'add_to_cart', count(*) FROM t2
UNION ALL SELECT 3, 'checkout', count(*) FROM t3
UNION ALL SELECT 4, 'purchase', count(*) FROM t4"""

ABANDONED_CARTS = f"""WITH {EV},
s AS (
  SELECT session_id,
         max(CASE WHEN event_type = 'add_to_cart' THEN "timestamp" END) AS last_cart_at,
         max(CASE WHEN event_type = 'purchase' THEN "timestamp" END) AS last_purchase_at,
         max("timestamp") AS last_event_at,
         count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_events
  FROM evp GROUP BY 1)
SELECT session_id, last_cart_at, last_event_at, cart_events FROM s
WHERE last_cart_at IS NOT NULL AND (last_purchase_at IS NULL OR last_purchase_at < last_cart_at)
  AND last_event_at <= (SELECT max("timestamp") FROM evp) - INTERVAL 1 DAY"""

TRAFFIC_BY_REFERRER = f"""WITH {EV},
h AS (SELECT *, CASE WHEN k % 5 IN (0, 1) THEN NULL ELSE 'site' || CAST(k % 7 AS VARCHAR) || '.example.com' END
        AS host FROM evp)
SELECT coalesce(host, '(direct)') AS referrer_host,
       count(*) AS event_count, count(DISTINCT session_id) AS sessions
FROM h GROUP BY 1"""

STRICT_ACCEPTED = f"""WITH {EV}
SELECT CASE WHEN raw_event_id % 50 = 8 THEN NULL ELSE event_id END AS event_id,
       "timestamp", user_id, anonymous_id, session_id, event_type, page_url,
       CAST(NULL AS VARCHAR) AS referrer_url,
       'os-' || CAST(raw_user_id % {DEVICE_KINDS} AS VARCHAR) AS device_os,
       'browser-' || CAST(raw_user_id % {DEVICE_KINDS} AS VARCHAR) AS device_browser,
       CAST(NULL AS VARCHAR) AS device_ip_address,
       '{DEVICE_AGENT}' AS device_user_agent,
       price, product_id, CAST(json(properties) AS VARCHAR) AS properties
FROM evp
WHERE NOT {_BAD}"""

_REASONS = f"""WITH {EV},
r AS (
  SELECT 'malformed_json' AS reason FROM evp WHERE raw_event_id % 50 = 0
  UNION ALL SELECT 'not_an_object' FROM evp WHERE raw_event_id % 50 = 9
  UNION ALL SELECT 'session_id:missing' FROM evp WHERE raw_event_id % 50 = 1
  UNION ALL SELECT 'page_url:null' FROM evp WHERE raw_event_id % 50 = 2
  UNION ALL SELECT 'user_id:not_a_string' FROM evp WHERE raw_event_id % 50 = 3
  UNION ALL SELECT 'event_id:not_a_string' FROM evp WHERE raw_event_id % 50 = 10
  UNION ALL SELECT 'price:not_a_number' FROM evp WHERE raw_event_id % 50 = 12
  UNION ALL SELECT 'properties:null' FROM evp WHERE raw_event_id % 50 = 7
  UNION ALL SELECT 'event_type:not_allowed' FROM evp
            WHERE raw_event_id % 50 NOT IN (0, 9) AND event_type NOT IN ({_ENUM}))"""

STRICT_REJECTED = _REASONS + """
SELECT reason, count(*) AS rejected_events FROM r GROUP BY 1"""

INGEST_QUALITY = f"""WITH {EV},
flags AS (
  SELECT raw_event_id % 50 IN (0, 9) AS malformed,
         {_BAD} AS bad
  FROM evp),
c AS (
  SELECT count(*) AS total_events, count(*) FILTER (WHERE NOT bad) AS accepted_events,
         count(*) FILTER (WHERE bad) AS rejected_events,
         count(*) FILTER (WHERE malformed) AS malformed_events
  FROM flags)
SELECT *, CASE WHEN total_events > 0
               THEN CAST(accepted_events AS DOUBLE) * 100.0 / CAST(total_events AS DOUBLE)
               ELSE 0.0 END AS success_pct
FROM c"""

ROUTING_KEYS = f"""WITH {EV}
SELECT event_id, coalesce(nullif(user_id, ''), anonymous_id) AS routing_key FROM evp"""

_CELLS = ("event_time", "raw_event_type", "product_raw", "category_raw", "code_raw", "brand_raw", "price_raw",
          "user_raw", "session_raw")
_FP = "md5(md5(concat_ws('|', " + ", ".join(
    f"coalesce(length({c}) || ':' || {c}, '-')" for c in _CELLS) + ")) || '#' || copy)"

EXPORT_NORMALIZED = f"""WITH {EV},
x AS (
  SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time,
         user_id AS user_raw,
         CASE WHEN raw_event_id % 13 = 0 THEN NULL ELSE session_id END AS session_raw,
         nullif(product_id, '') AS product_raw, CAST(k AS VARCHAR) AS category_raw,
         CASE WHEN k % 3 = 0 THEN 'electronics.smartphone' END AS code_raw,
         CASE WHEN k % 4 = 0 THEN 'acme' END AS brand_raw,
         CAST(price AS VARCHAR) AS price_raw
  FROM evp),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY {", ".join(_CELLS)}) - 1 AS VARCHAR) AS copy FROM x),
y AS (SELECT *, {_FP} AS fp FROM n)
SELECT substr(fp, 1, 8) || '-' || substr(fp, 9, 4) || '-' || substr(fp, 13, 4) || '-' ||
         substr(fp, 17, 4) || '-' || substr(fp, 21, 12) AS event_id,
       date_trunc('second', ts) AS "timestamp",
       user_raw AS user_id,
       'anon_' || coalesce(user_raw, coalesce(session_raw, 'sess_' || substr(fp, 1, 12))) AS anonymous_id,
       coalesce(session_raw, 'sess_' || substr(fp, 1, 12)) AS session_id,
       CASE raw_event_type WHEN 'purchase' THEN 'purchase' ELSE 'view_item' END AS event_type,
       page_url, price, product_key AS product_id,
       '{{"category_id":"' || CAST(k AS VARCHAR) || '"'
         || CASE WHEN k % 3 = 0 THEN ',"category_code":"electronics.smartphone"' ELSE '' END
         || CASE WHEN k % 4 = 0 THEN ',"brand":"acme"' ELSE '' END || '}}' AS properties
FROM y"""

def _jstr(col: str) -> str:
    """JSON text of a nullable string column (the data holds no characters
    that need escaping)."""
    return f"CASE WHEN {col} IS NULL THEN 'null' ELSE '\"' || {col} || '\"' END"


_ISO_TS = ("CASE WHEN microsecond(\"timestamp\") % 1000000 = 0 "
           "THEN strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S') "
           "ELSE strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00'")

CANONICAL_MESSAGES = f"""WITH {EV}
SELECT coalesce(nullif(user_id, ''), anonymous_id) AS key,
       '{{"event_id":' || {_jstr('event_id')} ||
       ',"timestamp":"' || {_ISO_TS} || '"' ||
       ',"user_id":' || {_jstr('user_id')} ||
       ',"anonymous_id":' || {_jstr('anonymous_id')} ||
       ',"session_id":' || {_jstr('session_id')} ||
       ',"event_type":' || {_jstr('event_type')} ||
       ',"page_url":' || {_jstr('page_url')} ||
       ',"referrer_url":null,"device":null' ||
       ',"price":' || CASE WHEN price IS NULL THEN 'null' ELSE CAST(price AS VARCHAR) END ||
       ',"product_id":' || {_jstr('product_id')} ||
       ',"properties":' || CAST(json(properties) AS VARCHAR) || '}}' AS value
FROM evp"""

DEDUP_EVENTS = f"""WITH {EV}
SELECT {FLAT} FROM evp"""

_LAKE_COLS = (FLAT + ', CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month, '
              'CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour')

LAKE_DAY_SLICE = f"""WITH {EV}
SELECT {_LAKE_COLS} FROM evp WHERE day("timestamp") = 4"""

LAKE_PREVIEW = f"""WITH {EV}
SELECT {_LAKE_COLS} FROM evp ORDER BY "timestamp", event_id LIMIT 100"""

LAKE_INVENTORY = f"""WITH {EV}
SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour,
       count(*) AS n_rows
FROM evp GROUP BY 1, 2, 3, 4"""


LAKE_COMPACTED = f"""WITH {EV}
SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour,
       count(*) AS n_rows, CAST(sum(raw_event_id) AS BIGINT) AS id_sum, count(DISTINCT event_id) AS ids,
       count(product_id) AS products, max(properties) AS last_properties, CAST(1 AS BIGINT) AS n_files
FROM evp GROUP BY 1, 2, 3, 4"""

STREAM_ABANDONED_CARTS = f"""WITH {EV},
gaps AS (
  SELECT session_id, event_type, "timestamp" AS t,
         CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY session_id ORDER BY "timestamp")
                   <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens FROM evp),
visits AS (
  SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS visit FROM gaps),
v AS (
  SELECT session_id, min(t) AS visit_start, max(t) AS last_event_at,
         max(CASE WHEN event_type = 'add_to_cart' THEN t END) AS last_cart_at,
         max(CASE WHEN event_type = 'purchase' THEN t END) AS last_purchase_at,
         count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_events
  FROM visits GROUP BY session_id, visit)
SELECT session_id, visit_start, last_cart_at, last_event_at, cart_events FROM v
WHERE last_cart_at IS NOT NULL AND (last_purchase_at IS NULL OR last_purchase_at < last_cart_at)
  AND last_event_at + INTERVAL 2 HOUR
      <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM evp) - INTERVAL 1 HOUR"""

STREAM_STATE_AUDIT = f"""WITH {EV},
a AS (
  SELECT event_type, {_bucket(86400)} + INTERVAL 86400 SECOND AS window_end, product_key AS product_id,
         count(*) AS n
  FROM evp GROUP BY 1, 2, 3)
SELECT event_type, window_end, product_id, n AS state_count, n AS served_count FROM a
WHERE window_end > (SELECT date_trunc('milliseconds', max("timestamp")) FROM evp) - INTERVAL 1 HOUR"""

UNIQUE_USERS_RANGE = f"""WITH {EV},
days AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS day, user_id FROM evp)
SELECT CAST(day - back AS TIMESTAMP) AS range_start, CAST(day - back + 7 AS TIMESTAMP) AS range_end,
       count(DISTINCT user_id) AS unique_users, TRUE AS within_bound
FROM days, (SELECT CAST(unnest(range(7)) AS INTEGER) AS back) GROUP BY 1, 2"""

STREAM_INGEST_LAKE = f"""WITH {EV}
SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour,
       count(*) AS n_rows
FROM evp WHERE raw_event_id % 50 NOT IN (0, 9) GROUP BY 1, 2, 3, 4"""

STREAM_INGEST_QUARANTINE = f"""WITH {EV}
SELECT CASE WHEN raw_event_id % 50 = 0 THEN 'malformed_json' ELSE 'not_an_object' END AS reason,
       count(*) AS messages
FROM evp WHERE raw_event_id % 50 IN (0, 9) GROUP BY 1"""


ARCHIVE_PAYLOAD = f"""WITH {EV},
twice AS (SELECT * FROM evp UNION ALL SELECT * FROM evp WHERE raw_event_id % 7 = 0)
SELECT CASE WHEN raw_event_id % 50 = 6 THEN 'someone@example.com' END AS email, '1920x1080' AS screen,
       CASE WHEN raw_event_id % 50 = 3 THEN CAST(raw_user_id AS VARCHAR) ELSE user_id END AS user_sent,
       raw_event_id % 50 = 10 AS id_lost, {_BAD} AS rejected, count(*) AS messages
FROM twice WHERE raw_event_id % 50 NOT IN (0, 9) GROUP BY ALL"""

LAKE_DEDUP = f"""WITH {EV}
SELECT event_type, CAST("timestamp" AS DATE) AS day,
       CAST(sum(CASE WHEN raw_event_id % 50 = 10 AND raw_event_id % 7 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS event_count,
       count(DISTINCT CASE WHEN raw_event_id % 50 <> 10 THEN raw_event_id END) AS ids
FROM evp WHERE raw_event_id % 50 NOT IN (0, 9) GROUP BY ALL"""


def stream_json_product_counts(size: str) -> str:
    s = _SECONDS[size]
    return f"""WITH {EV}
SELECT event_type, {_bucket(s)} + INTERVAL {s} SECOND AS window_end, product_key AS product_id,
       count(*) AS event_count
FROM evp WHERE NOT {_BAD} GROUP BY 1, 2, 3"""


def stream_event_stats(size: str) -> str:
    return event_window_stats(size)


STREAM_LATE_COUNTS = f"""WITH {EV},
last AS (SELECT max("timestamp") AS latest FROM evp),
again AS (SELECT "timestamp" FROM evp WHERE raw_event_id % 7 = 0)
SELECT CAST((SELECT count(*) FROM evp) + (SELECT count(*) FROM evp, last WHERE "timestamp" = latest)
            + (SELECT count(*) FROM again) AS BIGINT) AS rows,
       (SELECT count(*) FROM again, last
        WHERE {_bucket(60)} + INTERVAL 60 SECOND
              <= date_trunc('milliseconds', latest) - INTERVAL 1 HOUR) AS late"""

STREAM_LATE_CORRECTED = f"""WITH {EV},
a AS (
  SELECT * FROM evp
  UNION ALL SELECT * FROM evp WHERE "timestamp" = (SELECT max("timestamp") FROM evp)
  UNION ALL SELECT * FROM evp WHERE raw_event_id % 7 = 0)
SELECT event_type, {_bucket(60)} + INTERVAL 60 SECOND AS window_end, product_key AS product_id,
       count(*) AS event_count
FROM a GROUP BY 1, 2, 3"""

ORACLE: dict[str, str] = {}
for _s in _SECONDS:
    ORACLE[f"product_window_counts_{_s}"] = product_window_counts(_s)
    ORACLE[f"event_window_rollup_{_s}"] = event_window_rollup(_s)
    ORACLE[f"event_window_stats_{_s}"] = event_window_stats(_s)
    ORACLE[f"rolling_counts_{_s}"] = rolling_counts(_s)
    ORACLE[f"stream_product_counts_{_s}"] = served_product_counts(_s)
    ORACLE[f"stream_event_stats_{_s}"] = stream_event_stats(_s)
ORACLE.update({
    "product_views_total": PRODUCT_VIEWS,
    "trending_products": TRENDING,
    "events_by_type": EVENTS_BY_TYPE,
    "unique_users_sessions": UNIQUE_USERS_SESSIONS,
    "daily_trend": DAILY_TREND,
    "conversion_funnel": CONVERSION_FUNNEL,
    "funnel_ordered": FUNNEL_ORDERED,
    "abandoned_carts": ABANDONED_CARTS,
    "traffic_by_referrer": TRAFFIC_BY_REFERRER,
    "strict_accepted": STRICT_ACCEPTED,
    "strict_rejected_by_reason": STRICT_REJECTED,
    "ingest_quality": INGEST_QUALITY,
    "routing_keys": ROUTING_KEYS,
    "canonical_messages": CANONICAL_MESSAGES,
    "export_normalized": EXPORT_NORMALIZED,
    "dedup_events": DEDUP_EVENTS,
    "archive_payload": ARCHIVE_PAYLOAD,
    "lake_dedup": LAKE_DEDUP,
    "lake_compacted": LAKE_COMPACTED,
    "trending_bounded": TRENDING,
    "unique_users_range": UNIQUE_USERS_RANGE,
    "stream_state_audit": STREAM_STATE_AUDIT,
    "stream_json_product_counts": stream_json_product_counts("60s"),
    "stream_event_rollup_view": event_window_rollup("60s"),
    "stream_trending": TRENDING,
    "lake_day_slice": LAKE_DAY_SLICE,
    "lake_preview": LAKE_PREVIEW,
    "lake_inventory": LAKE_INVENTORY,
    "stream_product_views": PRODUCT_VIEWS,
    "stream_dedup_counts": served_product_counts("60s"),
    "stream_late_counts": STREAM_LATE_COUNTS,
    "stream_late_corrected": STREAM_LATE_CORRECTED,
    "stream_abandoned_carts": STREAM_ABANDONED_CARTS,
    "stream_ingest_lake": STREAM_INGEST_LAKE,
    "stream_ingest_quarantine": STREAM_INGEST_QUARANTINE,
})
