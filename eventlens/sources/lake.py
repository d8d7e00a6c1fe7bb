"""S3 partitioned lake scan and S11 lake inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.contract import LAKE_PARTITIONS, LAKE_SCHEMA, nullable


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """Scan the lake *root* with the fixed schema.

    Reading the root (not a glob) keeps partition discovery, so filters on
    year/month/day/hour become PartitionFilters and prune directories.
    """
    return (spark.read.schema(nullable(LAKE_SCHEMA))
            .option("basePath", root)
            .parquet(root))


def lake_slice(spark: SparkSession, root: str, **parts: int) -> DataFrame:
    """P13 + P14: every row (all columns) whose partition values match."""
    df = read_lake(spark, root)
    for name, value in parts.items():
        if name not in LAKE_PARTITIONS:
            raise ValueError(f"not a partition column: {name}")
        df = df.filter(F.col(name) == F.lit(value))
    return df


def lake_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files, rows and bytes per partition, from file metadata.

    Two small aggregations: per file (rows; the size is a file attribute), then
    per partition.  No data column is read.
    """
    scan = read_lake(spark, root).select(
        *LAKE_PARTITIONS,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"))
    per_file = scan.groupBy(*LAKE_PARTITIONS, "file_path").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("file_size").alias("n_bytes"))
    return per_file.groupBy(*LAKE_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"))


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """S11 without reading data: files and bytes per partition from a listing.

    The ``binaryFile`` source reads file contents only when ``content`` is
    selected; here only path and length are, so the cost is the listing
    (the reference's object listing), whatever the lake's size.
    """
    listing = (spark.read.format("binaryFile")
               .option("pathGlobFilter", "*.parquet")
               .option("basePath", root)
               .load(root)
               .select(*[F.col(p).cast("int").alias(p) for p in LAKE_PARTITIONS], "path", "length"))
    return listing.groupBy(*LAKE_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


def lake_range(spark: SparkSession, root: str, start, end, time_col: str = "arrival_ts") -> DataFrame:
    """Rows with ``start <= time_col < end``, reading only the hour folders
    that can hold them.

    The lake is partitioned by ``time_col``'s UTC hour, but Catalyst cannot
    derive a partition predicate from a filter on the timestamp itself.  This
    adds one over the partition columns alone (the folder's hour), which
    becomes a PartitionFilter, and keeps the exact row filter.
    """
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    folder_hour = F.make_timestamp(F.col("year"), F.col("month"), F.col("day"), F.col("hour"),
                                   F.lit(0), F.lit(0))
    pruned = read_lake(spark, root).filter(
        (folder_hour >= F.date_trunc("hour", lo)) & (folder_hour < hi))
    return pruned.filter((F.col(time_col) >= lo) & (F.col(time_col) < hi))
