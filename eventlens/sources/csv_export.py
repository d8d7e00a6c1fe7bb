"""CSV exports, read as all-string columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_export(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Header CSV, every column a string (no inference).

    A UTF-8 byte-order mark is stripped by Spark's reader.  With ``columns``
    the header is still required but names come from the given list, so a
    large export is not scanned twice to infer a header.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in columns]))
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(path)
