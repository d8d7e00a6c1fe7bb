"""Sinks: partitioned Parquet archive, keyed serving tables, topic."""
