"""Keyed serving tables with replay-safe upserts.

Without a MERGE-capable table format, a serving table is a folder of
versions plus a compacted snapshot:

* micro-batch N overwrites ``<root>/versions/batch_id=N`` (a retried batch
  replaces its own output, never duplicates it);
* ``compact`` folds everything up to the newest committed batch T into
  ``<root>/snapshot/snap_id=T`` (each row keeps the batch id it came from).

A version or snapshot counts once its ``_SUCCESS`` mark is there; a folder
without it (a crash while writing) is never read, and a committed snapshot is
never written again.  Compaction deletes only what the snapshot *before* the new
one covers, so a reader that planned on that one still finds its files, and an
interrupted compaction leaves the table as it was.

Readers take, per key, the row with the highest batch id over the newest
snapshot and the versions after it.  In update mode each changed key is
re-emitted with its *full* current value, so "last write wins" is right.  On a
cluster with a database the same foreachBatch can instead write a staging table
and run ON CONFLICT.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.windows import event_window_rollup


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_ids(spark: SparkSession, path: str, prefix: str, committed: bool = True) -> list[int]:
    """Numeric suffixes of ``prefix=<n>`` folders under ``path`` (a listing); only those with a commit mark,
    or all."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    ids = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        number = name.removeprefix(prefix + "=")
        if st.isDirectory() and number != name and number.isdigit():
            if not committed or fs.exists(_fs(spark, f"{path}/{name}/_SUCCESS")[1]):
                ids.append(int(number))
    return sorted(ids)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class ServingTable:
    def __init__(self, root: str, keys: Sequence[str], compact_every: int | None = 100):
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.compact_every = compact_every

    @property
    def versions_root(self) -> str:
        return f"{self.root}/versions"

    @property
    def snapshot_root(self) -> str:
        return f"{self.root}/snapshot"

    # -- write side -------------------------------------------------------
    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch callback: the batch always consumes its input."""
        batch.write.mode("overwrite").parquet(f"{self.versions_root}/batch_id={int(batch_id)}")
        if self.compact_every and int(batch_id) % self.compact_every == self.compact_every - 1:
            self.compact(batch.sparkSession)

    # -- read side --------------------------------------------------------
    def _latest(self, spark: SparkSession) -> DataFrame | None:
        """The newest row of every key with its batch_id, from committed folders only."""
        snaps = child_ids(spark, self.snapshot_root, "snap_id")
        since = snaps[-1] if snaps else -1
        batches = [b for b in child_ids(spark, self.versions_root, "batch_id") if b > since]
        parts = []
        if batches:
            parts.append(spark.read.option("basePath", self.versions_root).parquet(
                *(f"{self.versions_root}/batch_id={b}" for b in batches))
                .withColumn("batch_id", F.col("batch_id").cast("bigint")))
        if snaps:
            parts.append(spark.read.parquet(f"{self.snapshot_root}/snap_id={since}"))
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        values = [c for c in rows.columns if c not in self.keys and c != "batch_id"]
        latest = rows.groupBy(*self.keys).agg(
            F.max_by(F.struct(*values, F.col("batch_id")), F.col("batch_id")).alias("_v"))
        return latest.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in [*values, "batch_id"]])

    def read(self, spark: SparkSession) -> DataFrame:
        """The current table: latest version of every key."""
        rows = self._latest(spark)
        if rows is None:
            raise FileNotFoundError(f"serving table {self.root} has no committed batch yet")
        return rows.drop("batch_id")

    def compact(self, spark: SparkSession) -> int | None:
        """Fold the versions since the last snapshot into a new one.

        Returns the newest batch id folded, or None when nothing is newer than the last snapshot.
        """
        snaps = child_ids(spark, self.snapshot_root, "snap_id")
        before = snaps[-1] if snaps else -1
        newer = [b for b in child_ids(spark, self.versions_root, "batch_id") if b > before]
        if not newer:
            return None
        # a folder of this name, if any, has no commit mark: nobody reads it
        self._latest(spark).write.mode("overwrite").parquet(f"{self.snapshot_root}/snap_id={newer[-1]}")
        for b in child_ids(spark, self.versions_root, "batch_id"):
            if b <= before:
                _delete(spark, f"{self.versions_root}/batch_id={b}")
        for s in child_ids(spark, self.snapshot_root, "snap_id", committed=False):
            if s < before:
                _delete(spark, f"{self.snapshot_root}/snap_id={s}")
        return newer[-1]


# Names of the served table and its rollup view (fixed values).
PRODUCT_METRICS_VIEW = "realtime_product_metrics"
EVENT_METRICS_VIEW = "realtime_event_metrics"


def register_serving_views(spark: SparkSession, product_counts: ServingTable) -> None:
    """S12 + A2: the served A1 table and its rollup per type and window, as SQL views."""
    served = product_counts.read(spark)
    served.createOrReplaceTempView(PRODUCT_METRICS_VIEW)
    event_window_rollup(served).createOrReplaceTempView(EVENT_METRICS_VIEW)
