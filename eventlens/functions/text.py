"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.functions.contract import DEFAULT_PRODUCT

# Characters removed by a whitespace strip: exactly the characters Python's
# str.strip() removes (str.isspace), so tabs and newlines go too.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c: Column | str) -> Column:
    """Trim all whitespace; plain ``trim`` only removes spaces."""
    col = F.col(c) if isinstance(c, str) else c
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(col, F.lit(""))


def or_default(c: Column | str, default: str | Column) -> Column:
    """Python's ``x or default`` for strings: null and "" both fall back."""
    d = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(blank_to_null(c), d)


def default_product(c: Column | str = "product_id") -> Column:
    """Missing, null or empty product ids become PROD_GENERAL."""
    return or_default(c, DEFAULT_PRODUCT)


def routing_key(user_id: Column | str = "user_id",
                anonymous_id: Column | str = "anonymous_id") -> Column:
    """The partition key sent with each message, ``user_id or anonymous_id``."""
    a = F.col(anonymous_id) if isinstance(anonymous_id, str) else anonymous_id
    return or_default(user_id, a)
