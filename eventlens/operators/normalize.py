"""Lenient normalisation of CSV exports to the contract.

Unlike the strict validator, nothing is rejected here: unknown event types
become ``view_item``, bad prices become null, unparsable times take the job's
ingest time.  Everything is a native column expression; the only per-row
computation is an MD5 fingerprint of the raw cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.contract import DEFAULT_PAGE_URL_PREFIX
from eventlens.functions.text import default_product, strip_ws
from eventlens.functions.time import parse_event_time

# --- Fixed values (must equal the reference's) ------------------------------
# Header aliases per field: first the capitalised export, then the snake_case one.
ALIASES = {
    "event_type": ("EventType", "event_type"),
    "time": ("Timestamp", "event_time"),
    "user": ("UserID", "user_id"),
    "session": ("SessionID", "user_session"),
    "product": ("ProductID", "product_id"),
    "price": ("Amount", "price"),
    "outcome": ("Outcome", "outcome"),
}
# Extra columns copied into properties when non-empty.
PROPERTY_EXTRAS = ("category_id", "category_code", "brand")
# Lower-cased raw type -> contract type; anything else is view_item.
EVENT_TYPE_MAP = {
    "view": "view_item",
    "product_view": "product_view",
    "page_view": "view_item",
    "click": "view_item",
    "cart": "add_to_cart",
    "add_to_cart": "add_to_cart",
    "purchase": "purchase",
    "checkout": "checkout",
}
FALLBACK_EVENT_TYPE = "view_item"
# Number text: digits that single underscores may group, an exponent, or infinity or nan.
NUMBER = (r"^(?i)[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
          r"|^[+-]?(inf|infinity|nan)$")
# -----------------------------------------------------------------------------


def resolve_alias(columns: Sequence[str], field: str) -> str | None:
    """The first alias of ``field`` present in the header, or None."""
    for name in ALIASES[field]:
        if name in columns:
            return name
    return None


def _raw(df: DataFrame, field: str) -> Column:
    name = resolve_alias(df.columns, field)
    return F.col(f"`{name}`") if name else F.lit(None).cast("string")


def _val(raw: Column) -> Column:
    """The stripped value; a missing cell reads as ''."""
    return F.coalesce(strip_ws(raw), F.lit(""))


def row_fingerprint(df: DataFrame) -> Column:
    """MD5 of every cell, each with its length (``-`` if missing), so no two rows read alike."""
    cells = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return F.md5(F.concat_ws("|", *(
        F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells)))


#: Copies of a row that one task writes out again.
COPY_BLOCK = 10_000


def numbered_copies(raw: DataFrame, name: str = "_copy", block: int = COPY_BLOCK) -> DataFrame:
    """``raw`` with the number of each row among its equals (0, 1, ...).

    Equal rows are counted (map-side first) and written out again, so the
    numbers are the same on every replay and no task sorts a group of copies.
    Groups of more than ``block`` rows are dealt out by blocks of copies first.
    """
    cells = [F.col(f"`{c}`") for c in raw.columns]
    counted = raw.groupBy(*cells).agg(F.count(F.lit(1)).alias("_copies"))
    zero = F.lit(0).cast("bigint")
    few = counted.filter(F.col("_copies") <= block).select(
        *cells, F.explode(F.sequence(zero, F.col("_copies") - 1)).alias(name))
    parts = (counted.filter(F.col("_copies") > block)
             .select(*cells, "_copies", F.explode(F.sequence(zero, F.floor((F.col("_copies") - 1) / block))).alias("_block"))
             .repartition(*cells, "_block"))
    first = F.col("_block") * block
    many = parts.select(*cells, F.explode(F.sequence(first, F.least(first + block, F.col("_copies")) - 1)).alias(name))
    return few.unionByName(many)


def normalize_export(raw: DataFrame, ingest_ts: Column | None = None,
                     page_url_prefix: str = DEFAULT_PAGE_URL_PREFIX) -> DataFrame:
    """Map a CSV export (all-string columns, either header style) to the contract.

    ``ingest_ts`` replaces unparsable or empty times (default: the query's
    current time).  event_id and a missing session id are derived from all cells
    of the row and its number among equal rows, so every row has ids of its own
    and re-running a file gives the same ones.
    """
    ingest = ingest_ts if ingest_ts is not None else F.current_timestamp()
    fp = F.md5(F.concat(row_fingerprint(raw), F.lit("#"), F.col("_copy").cast("string")))
    raw = numbered_copies(raw)

    etype_raw = F.lower(_val(_raw(raw, "event_type")))
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_MAP.items() for x in kv])
    event_type = F.coalesce(F.element_at(mapping, etype_raw), F.lit(FALLBACK_EVENT_TYPE))

    time_txt = _val(_raw(raw, "time"))
    ts = F.coalesce(parse_event_time(time_txt), ingest)

    user = F.nullif(_val(_raw(raw, "user")), F.lit(""))
    session = F.coalesce(F.nullif(_val(_raw(raw, "session")), F.lit("")),
                         F.concat(F.lit("sess_"), F.substring(fp, 1, 12)))
    anonymous = F.concat(F.lit("anon_"), F.coalesce(user, session))

    product = default_product(_val(_raw(raw, "product")))
    price_txt = _val(_raw(raw, "price"))
    # digit-group underscores ("1_000.5") are fine; Spark's cast also takes "1.5d" and "0x1p3", which are no prices
    price = F.when(price_txt.rlike(NUMBER), F.regexp_replace(price_txt, "_", "").try_cast("double"))

    outcome = _val(_raw(raw, "outcome"))
    entries = [F.lit("outcome"), outcome]
    for extra in PROPERTY_EXTRAS:
        if extra in raw.columns:
            c = F.col(f"`{extra}`")
            # included when the raw cell is non-empty; the stored value is stripped
            entries += [F.lit(extra), F.when(c != "", strip_ws(c))]
    props = F.map_filter(F.create_map(*entries),
                         lambda k, v: v.isNotNull() & ((k != "outcome") | (v != "")))

    event_id = F.concat_ws("-", F.substring(fp, 1, 8), F.substring(fp, 9, 4),
                           F.substring(fp, 13, 4), F.substring(fp, 17, 4), F.substring(fp, 21, 12))
    return raw.select(
        event_id.alias("event_id"),
        ts.alias("timestamp"),
        user.alias("user_id"),
        anonymous.alias("anonymous_id"),
        session.alias("session_id"),
        event_type.alias("event_type"),
        F.concat(F.lit(page_url_prefix), product).alias("page_url"),
        F.lit(None).cast("string").alias("referrer_url"),
        F.lit(None).cast("struct<os:string,browser:string,ip_address:string,user_agent:string>")
        .alias("device"),
        price.alias("price"),
        product.alias("product_id"),
        F.to_json(props).alias("properties"),
        ingest.alias("arrival_ts"))
