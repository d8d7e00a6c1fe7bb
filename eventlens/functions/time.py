"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.functions.contract import LAKE_PARTITIONS

_PART_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def partition_parts(time_col: Column | str) -> list[Column]:
    """Zero-padded year/month/day/hour text (``month=01`` in the path).

    The lake schema reads them back as INT, so ``day = 4`` keeps working.
    """
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    return [F.date_format(t, _PART_FORMATS[p]).alias(p) for p in LAKE_PARTITIONS]


def iso_utc(c: Column | str) -> Column:
    """ISO 8601 text as Python's ``isoformat()`` writes an aware UTC time:
    ``+00:00`` offset, and a six-digit fraction only when it is not zero."""
    col = F.col(c) if isinstance(c, str) else c
    whole = F.unix_micros(col) % 1000000 == 0
    return F.when(whole, F.date_format(col, "yyyy-MM-dd'T'HH:mm:ssxxx")) \
        .otherwise(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def from_epoch_millis(c: Column | str) -> Column:
    """Epoch milliseconds (a window end from another engine) to TIMESTAMP."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_millis(col.cast("long"))


def parse_event_time(raw: Column) -> Column:
    """Text to TIMESTAMP, UTC.

    A trailing " UTC" is removed and any zone offset is *dropped*, not applied:
    the wall-clock time is taken as UTC.  ISO forms with 'T' or a space and any
    number of fraction digits are accepted; anything else yields NULL, and the
    caller decides the fallback.
    """
    from eventlens.functions.text import strip_ws
    s = strip_ws(F.replace(raw, F.lit(" UTC"), F.lit("")))
    # a zone suffix is dropped only after a time of day ("2024-01-15" keeps its "-15")
    s = F.regexp_replace(
        s, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)(?:Z|[+-]\d{2}(?::?\d{2})?)$", "$1")
    iso_like = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$")
    return F.when(iso_like, F.try_to_timestamp(s))
