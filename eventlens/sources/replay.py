"""The contract view over the driver's ``events`` table.

The driver's table has no clickstream fields, so each is derived
deterministically from the row (the same rules appear in the DuckDB oracle):

* event_id: the numeric id as text; timestamp and arrival_ts: ``ts`` as UTC;
* user_id: null when event_id % 11 = 0 (anonymous visitors), else the id;
* anonymous_id ``anon_<user>``; session_id ``sess_<user>_<yyyyMMdd>``;
* event_type: view->product_view, click->add_to_cart, signup->checkout,
  purchase->purchase, error stays error (invalid on purpose);
* product_id from props.k: k%10=0 null, k%10=1 empty, else ``PROD_<k>``;
* page_url: prefix + product id (after the default); price: value;
  properties: props.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.contract import CONTRACT_COLUMNS, DEFAULT_PAGE_URL_PREFIX, DEFAULT_PRODUCT

# Mapping of the table's event types to contract types (our derivation).
TABLE_TYPE_MAP = {
    "view": "product_view",
    "click": "add_to_cart",
    "signup": "checkout",
    "purchase": "purchase",
    "error": "error",
}


# Schema of the driver's ``events`` table; reading with it skips footer inference.
EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")
TABLE_SCHEMAS = {"events": EVENTS_SCHEMA}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contract_events(events: DataFrame, page_url_prefix: str = DEFAULT_PAGE_URL_PREFIX,
                    keep_raw_type: bool = False) -> DataFrame:
    """Map the driver's ``events`` rows to contract rows (see module doc)."""
    type_case = "CASE event_type " + " ".join(
        f"WHEN '{a}' THEN '{b}'" for a, b in TABLE_TYPE_MAP.items()) + " ELSE event_type END"
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    product = (f"CASE WHEN {k} % 10 = 0 THEN CAST(NULL AS STRING) WHEN {k} % 10 = 1 THEN '' "
               f"ELSE concat('PROD_', CAST({k} AS STRING)) END")
    uid = "CAST(user_id AS STRING)"
    ts = "CAST(ts AS TIMESTAMP)"
    cols = [
        "CAST(event_id AS STRING) AS event_id",
        f"{ts} AS timestamp",
        f"CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING) ELSE {uid} END AS user_id",
        f"concat('anon_', {uid}) AS anonymous_id",
        f"concat('sess_', {uid}, '_', date_format({ts}, 'yyyyMMdd')) AS session_id",
        f"{type_case} AS event_type",
        f"concat({_sql_text(page_url_prefix)}, coalesce(nullif({product}, ''), '{DEFAULT_PRODUCT}')) AS page_url",
        "CAST(NULL AS STRING) AS referrer_url",
        "CAST(NULL AS STRUCT<os: STRING, browser: STRING, ip_address: STRING, user_agent: STRING>) AS device",
        "CAST(value AS DOUBLE) AS price",
        f"{product} AS product_id",
        "props AS properties",
        f"{ts} AS arrival_ts",
    ]
    if keep_raw_type:
        cols += ["event_type AS raw_event_type", "user_id AS raw_user_id", "event_id AS raw_event_id"]
    out = events.selectExpr(*cols)
    assert tuple(out.columns[:len(CONTRACT_COLUMNS)]) == CONTRACT_COLUMNS
    return out


def load_contract_events(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return contract_events(read_table(spark, sf_dir, "events"), **kw)
