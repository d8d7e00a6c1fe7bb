"""Column-expression helpers: built-in Spark functions only, no Python UDFs."""

from eventlens.functions.contract import (  # noqa: F401
    CONTRACT_SCHEMA, DEVICE_FIELDS, EVENT_TYPES, REQUIRED_STRING_FIELDS,
)
