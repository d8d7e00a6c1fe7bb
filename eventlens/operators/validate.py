"""Strict validation of JSON event text against the contract.

One pass over the messages: the text is parsed once into a VARIANT, every
declared field is typed and checked with built-in expressions, and each row
gets an array of reasons.  ``is_valid`` is ``size(reasons) = 0``.  Accepted and
rejected rows come from the same DataFrame, so nothing is dropped silently.

Rules (the contract's):
* required strings anonymous_id, session_id, event_type, page_url: present,
  not null, JSON strings (a number is *not* coerced);
* event_type must be one of the five allowed values, compared as sent;
* optional strings user_id, referrer_url, product_id: null or string;
* price: null, a number, or a string that parses as a number;
* device: null or an object of optional strings; other keys are dropped;
* properties: an object; absent becomes ``{}``, an explicit null is rejected;
* event_id / timestamp: defaulted only when absent; explicit null is rejected;
* root strings are stripped of whitespace, device strings are not;
* undeclared fields are dropped (whitelist projection).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.contract import (
    CONTRACT_COLUMNS, DEVICE_FIELDS, EVENT_TYPES, OPTIONAL_STRING_FIELDS,
    PAYLOAD_COLUMNS, REQUIRED_STRING_FIELDS,
)
from eventlens.functions.text import WHITESPACE

MALFORMED = "malformed_json"
NOT_OBJECT = "not_an_object"



_NUMERIC = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
_SCALARS = ("event_id", "timestamp", *REQUIRED_STRING_FIELDS, *OPTIONAL_STRING_FIELDS, "price")
_OBJECTS = ("device", "properties")
_ISO = r"^\\s*\\d{4}-\\d{2}-\\d{2}([Tt _]\\d{2}:\\d{2}(:\\d{2}(\\.\\d+)?)?)?(Z|z|[+-]\\d{2}:?\\d{2})?\\s*$"


_DATE_SEP = r"^(\\d{4}-\\d{2}-\\d{2})[tT_ ]"
# number text: digits that single underscores may group, with an exponent, or infinity or nan
_FLOAT = r"^(?i)[+-]?((\\d+(_\\d+)*)(\\.(\\d+(_\\d+)*)?)?|\\.\\d+(_\\d+)*)(e[+-]?\\d+(_\\d+)*)?$|^[+-]?(inf|infinity|nan)$"
_EPOCH = r"^\\s*-?\\d+(\\.\\d+)?\\s*$"


# a text that parses is an object where it opens with a brace: no need to derive the whole document's schema
_IS_BAD = "_doc IS NULL"
_IS_OBJECT = "_doc IS NOT NULL AND startswith(ltrim('\\u0020\\u0009\\u000a\\u000d', raw), '{')"
_BAD_REASONS = f"array('{MALFORMED}')"
_NOT_OBJECT_REASONS = f"array('{NOT_OBJECT}')"


def _sql_str(text: str) -> str:
    """A SQL string literal with every character \\u-escaped (safe for any set)."""
    return "'" + "".join(f"\\u{ord(ch):04x}" for ch in text) + "'"


_WS = _sql_str(WHITESPACE)


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def validate_json(messages: DataFrame, value_col: str = "value",
                  arrival_col: str | None = None, id_mode: str = "hash",
                  position_cols: Sequence[str] = ()) -> DataFrame:
    """Parse and check JSON event text.

    Returns every input row with the contract columns (nullable), ``reasons``
    (array<string>), ``is_valid``, ``defaulted`` (fields that took a default)
    and the original text as ``raw``.  ``arrival_col`` names the arrival time
    (broker record time); without it the query's current time is used.
    ``id_mode='hash'`` derives a missing event_id from the message text and its
    place (``position_cols``: a topic's partition and offset), so a replay
    reproduces it and equal messages at different places stay different;
    without ``position_cols`` the arrival time is all that tells them apart.
    ``'uuid'`` draws a random id.

    Three narrow stages: parse; look up each declared path once (its kind,
    from ``schema_of_variant``, and its text); check and assemble.  The
    expressions are SQL text, so building the plan costs one call per column.
    """
    text = F.col(value_col).cast("string")
    arrival = F.col(arrival_col).cast("timestamp") if arrival_col else F.current_timestamp()
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in position_cols)) \
        if position_cols else F.coalesce(arrival.cast("string"), F.lit("-"))
    parsed = messages.select(text.alias("raw"), arrival.alias("_arrival"), place.alias("_place"),
                             F.try_parse_json(text).alias("_doc"))

    # -- stage 1: one lookup per declared path ---------------------------------
    ext = ["raw", "_arrival", "_place", f"{_IS_OBJECT} AS _obj", f"{_IS_BAD} AS _bad"]
    paths = [(n, f"$.{n}") for n in _SCALARS] + [(f"device_{n}", f"$.device.{n}") for n in DEVICE_FIELDS]
    for name, path in paths:
        v = f"variant_get(_doc, '{path}', 'variant')"
        ext += [f"schema_of_variant({v}) AS k_{name}",
                f"try_variant_get(_doc, '{path}', 'string') AS s_{name}"]
    ext.append("try_variant_get(_doc, '$.price', 'double') AS n_price")
    for name in _OBJECTS:
        ext.append(f"to_json(variant_get(_doc, '$.{name}', 'variant')) AS j_{name}")
    fields = _fence(parsed.selectExpr(*ext))

    # -- stage 2: checks on plain columns -----------------------------------------
    def present(n): return f"k_{n} IS NOT NULL"
    def is_null(n): return f"k_{n} = 'VOID'"
    def is_str(n): return f"k_{n} = 'STRING'"
    def is_num(n): return f"(k_{n} IN ({_in(_NUMERIC)}) OR startswith(k_{n}, 'DECIMAL'))"
    def as_str(n): return f"CASE WHEN {is_str(n)} THEN s_{n} END"
    def strip(e): return f"btrim({e}, {_WS})"
    def wrong_type(n): return f"{present(n)} AND NOT {is_null(n)} AND NOT {is_str(n)}"

    checks: list[str] = []
    values: dict[str, str] = {}

    def reason(cond: str, code: str) -> None:
        checks.append(f"CASE WHEN {cond} THEN '{code}' END")

    for n in REQUIRED_STRING_FIELDS:
        reason(f"NOT ({present(n)})", f"{n}:missing")
        reason(is_null(n), f"{n}:null")
        reason(wrong_type(n), f"{n}:not_a_string")
        if n == "event_type":
            reason(f"{is_str(n)} AND s_{n} NOT IN ({_in(EVENT_TYPES)})", "event_type:not_allowed")
            values[n] = as_str(n)
        else:
            values[n] = strip(as_str(n))

    for n in OPTIONAL_STRING_FIELDS:
        reason(wrong_type(n), f"{n}:not_a_string")
        values[n] = strip(as_str(n))

    reason(is_null("event_id"), "event_id:null")
    reason(wrong_type("event_id"), "event_id:not_a_string")
    if id_mode == "hash":
        h = "md5(concat(_place, '|', raw))"
        new_id = (f"concat_ws('-', substring({h}, 1, 8), substring({h}, 9, 4), substring({h}, 13, 4), "
                  f"substring({h}, 17, 4), substring({h}, 21, 12))")
    else:
        new_id = "uuid()"
    values["event_id"] = f"CASE WHEN k_event_id IS NULL THEN {new_id} ELSE {strip(as_str('event_id'))} END"

    n_ts = "CAST(s_timestamp AS DOUBLE)"
    # ISO text with any accepted separator (T, t, _, space) and z/Z, as Spark's cast wants it
    iso = (f"regexp_replace(regexp_replace(btrim(s_timestamp), '{_DATE_SEP}', '$1T'), "
           f"'[zZ]$', 'Z')")
    epoch = (f"CASE WHEN abs({n_ts}) > 2e10 THEN timestamp_millis(CAST({n_ts} AS BIGINT)) "
             f"ELSE timestamp_micros(CAST({n_ts} * 1e6 AS BIGINT)) END")
    # numbers, and strings holding a number, are Unix time (s, or ms beyond 2e10)
    ts = (f"CASE WHEN {is_str('timestamp')} THEN "
          f"  CASE WHEN s_timestamp RLIKE '{_ISO}' THEN try_to_timestamp({iso}) "
          f"       WHEN s_timestamp RLIKE '{_EPOCH}' THEN {epoch} END "
          f"WHEN {is_num('timestamp')} THEN {epoch} END")
    reason(is_null("timestamp"), "timestamp:null")
    reason(f"{present('timestamp')} AND NOT {is_null('timestamp')} AND ({ts}) IS NULL", "timestamp:invalid")
    values["timestamp"] = f"CASE WHEN k_timestamp IS NULL THEN _arrival ELSE {ts} END"

    price = (f"CASE WHEN {is_num('price')} THEN n_price "
             f"WHEN {is_str('price')} AND {strip('s_price')} RLIKE '{_FLOAT}' "
             f"  THEN try_cast(replace({strip('s_price')}, '_', '') AS DOUBLE) "
             f"WHEN k_price = 'BOOLEAN' THEN CAST(CAST(s_price AS BOOLEAN) AS DOUBLE) END")
    reason(f"{present('price')} AND NOT {is_null('price')} AND ({price}) IS NULL", "price:not_a_number")
    values["price"] = price

    dev_obj = "startswith(j_device, '{')"
    reason(f"j_device IS NOT NULL AND j_device != 'null' AND NOT {dev_obj}", "device:not_an_object")
    dev_fields = []
    for n in DEVICE_FIELDS:
        reason(f"{dev_obj} AND {wrong_type('device_' + n)}", f"device.{n}:not_a_string")
        dev_fields.append(f"'{n}', {as_str('device_' + n)}")
    values["device"] = f"CASE WHEN {dev_obj} THEN named_struct({', '.join(dev_fields)}) END"

    props_obj = "startswith(j_properties, '{')"
    reason("j_properties = 'null'", "properties:null")
    reason(f"j_properties IS NOT NULL AND j_properties != 'null' AND NOT {props_obj}",
           "properties:not_an_object")
    values["properties"] = (f"CASE WHEN j_properties IS NULL THEN '{{}}' "
                            f"WHEN {props_obj} THEN j_properties END")

    reasons = (f"CASE WHEN _bad THEN {_BAD_REASONS} WHEN NOT _obj THEN {_NOT_OBJECT_REASONS} "
               f"ELSE array_compact(array({', '.join(checks)})) END")
    defaulted = ("CASE WHEN _obj THEN array_compact(array("
                 "CASE WHEN k_event_id IS NULL THEN 'event_id' END, "
                 "CASE WHEN k_timestamp IS NULL THEN 'timestamp' END, "
                 "CASE WHEN j_properties IS NULL THEN 'properties' END)) "
                 "ELSE CAST(array() AS array<string>) END")
    cols = ["raw"]
    for c in CONTRACT_COLUMNS:
        cols.append("_arrival AS arrival_ts" if c == "arrival_ts" else
                    f"CASE WHEN _obj THEN {values[c]} END AS {c}")
    cols += [f"{reasons} AS reasons", f"{defaulted} AS defaulted"]
    # no fence here: a pushed-down ``is_valid`` filter re-evaluates the checks
    # on the looked-up columns (cheap), and unused values are pruned away
    return fields.selectExpr(*cols).selectExpr("*", "size(reasons) = 0 AS is_valid")


def _fence(df: DataFrame) -> DataFrame:
    """Stop filters on the results from being pushed below the checks.

    Catalyst pushes a filter such as ``is_valid`` through projections by
    substituting their expressions, which here would inline the JSON parse into
    every check (one parse per check, outside codegen).  Predicates cannot move
    below a generator that produces the columns they use, so the columns are
    passed through a one-element ``inline``: rows are unchanged.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def accepted(validated: DataFrame) -> DataFrame:
    """Valid rows, projected to the contract columns (P4 whitelist)."""
    return validated.filter(F.col("is_valid")).select(*CONTRACT_COLUMNS)


def rejected(validated: DataFrame) -> DataFrame:
    """Invalid rows with the original text and their reasons (quarantine)."""
    return validated.filter(~F.col("is_valid")).select("raw", "reasons", "arrival_ts")


def archivable(validated: DataFrame) -> DataFrame:
    """Rows the raw archive keeps: every message that parsed as a JSON object,
    valid or not.  The archive applies no contract, so beside the typed columns
    (null where a field has another type) each row keeps the whole message as
    ``raw`` and its ``reasons``.  Malformed text and bare scalars go to
    quarantine instead (:func:`unreadable`).  The rows are fenced off, or the
    filter would run every check a second time."""
    bad = F.array_contains("reasons", MALFORMED) | F.array_contains("reasons", NOT_OBJECT)
    return _fence(validated.select(*CONTRACT_COLUMNS, *PAYLOAD_COLUMNS)).filter(~bad)


def unreadable(messages: DataFrame, value_col: str = "value", arrival_col: str = "arrival_ts") -> DataFrame:
    """The messages that :func:`archivable` leaves out, with the reasons of :func:`validate_json`: text that doesn't
    parse, or not as an object.  That takes the parse alone, none of the checks on the fields."""
    text = F.col(value_col).cast("string")
    parsed = _fence(messages.select(text.alias("raw"), F.col(arrival_col).cast("timestamp").alias("arrival_ts"),
                                    F.try_parse_json(text).alias("_doc"))
                    .selectExpr("raw", "arrival_ts", f"{_IS_OBJECT} AS _obj", f"{_IS_BAD} AS _bad"))
    return parsed.filter("_bad OR NOT _obj").selectExpr(
        "raw", f"CASE WHEN _bad THEN {_BAD_REASONS} ELSE {_NOT_OBJECT_REASONS} END AS reasons", "arrival_ts")
