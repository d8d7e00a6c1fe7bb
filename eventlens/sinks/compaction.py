"""Small lake files merged under a manifest of live files.

A streaming archive writes a file per hour folder, task and batch.  ``compact``
packs an hour's small files into bins of about ``target_bytes`` and writes each
bin as one file; ``read`` takes the merged files in place of those they hold.
Files that the archive has written since count as live, so it needn't know of
any of this and may go on writing.

Layout beside the hour folders (Spark skips names with an underscore):

* ``_compacted/v=N/<hour>/bin=K/``: the files that compaction N wrote;
* ``_manifests/v=N``: every file known to it, with the compaction that retired it (null: live).

A manifest counts once its ``_SUCCESS`` mark is there and is never written
again.  Until then readers follow the one before, whose files are all still
there: a compaction that dies at any point leaves the lake as it was, and the
next one overwrites what it left.  ``vacuum`` deletes what was retired before the
newest manifest, so readers that planned on the manifest before that one find their files.
One compaction runs at a time.

File lists are DataFrames; a read hands Spark the paths of the hours it asks
for, as many as Spark's own file index holds for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.functions.contract import LAKE_PARTITIONS, LAKE_SCHEMA, nullable
from eventlens.session import scratch_path
from eventlens.sinks.serving import _delete, _fs, child_ids

TARGET_BYTES = 256 << 20

_COMPACTED, _MANIFESTS = "_compacted", "_manifests"
# path parts that name a file: four of the hour and the file; a merged one has two folders before and its bin
_OWN_PARTS, _MERGED_PARTS = len(LAKE_PARTITIONS) + 1, len(LAKE_PARTITIONS) + 4
_FILE = ["rel", "bytes", *LAKE_PARTITIONS]
_NONE = f"rel string, bytes bigint, {', '.join(f'{p} int' for p in LAKE_PARTITIONS)}"


class CompactedLake:
    def __init__(self, root: str, target_bytes: int = TARGET_BYTES):
        self.root, self.target_bytes = root.rstrip("/"), target_bytes

    # -- files ------------------------------------------------------------
    def _list(self, spark: SparkSession, base: str, parts: int) -> DataFrame:
        """The Parquet files under ``base``: path below the lake's root, size, hour.  For an archive with a sink log,
        the files that the log has committed and that still exist."""
        fs, path = _fs(spark, base)
        # a lake that has no file yet has no partition columns either
        if not fs.exists(path) or not any(s.isDirectory() and "=" in s.getPath().getName() for s in fs.listStatus(path)):
            return spark.createDataFrame([], _NONE)
        found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("ignoreMissingFiles", True)
                 .option("basePath", base).load(base))
        return found.select(F.substring_index("path", "/", -parts).alias("rel"), F.col("length").alias("bytes"),
                            *[F.col(p).cast("int").alias(p) for p in LAKE_PARTITIONS])

    def _own(self, spark: SparkSession) -> DataFrame:
        return self._list(spark, self.root, _OWN_PARTS)

    def version(self, spark: SparkSession) -> int | None:
        """The newest committed manifest."""
        versions = child_ids(spark, f"{self.root}/{_MANIFESTS}", "v")
        return versions[-1] if versions else None

    def manifest(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.schema(f"{_NONE}, retired_in bigint").parquet(f"{self.root}/{_MANIFESTS}/v={version}")

    def files(self, spark: SparkSession) -> DataFrame:
        """The live files: those of the manifest and those that came since (rel, bytes, hour)."""
        version = self.version(spark)
        own = self._own(spark)
        if version is None:
            return own
        known = self.manifest(spark, version)
        return (known.filter(F.col("retired_in").isNull()).select(*_FILE)
                .unionByName(own.join(known.select("rel"), "rel", "left_anti").select(*_FILE)))

    # -- rows -------------------------------------------------------------
    def _open(self, spark: SparkSession, rels: list[str]) -> DataFrame:
        """The rows of these files with the file each is from (``rel``)."""
        merged = [r for r in rels if r.startswith(f"{_COMPACTED}/")]
        own = [r for r in rels if not r.startswith(f"{_COMPACTED}/")]
        sides = []
        for some, base, parts in ((own, self.root, _OWN_PARTS), (merged, f"{self.root}/{_COMPACTED}", _MERGED_PARTS)):
            if some:
                rows = (spark.read.schema(nullable(LAKE_SCHEMA)).option("basePath", base)
                        .parquet(*[f"{self.root}/{r}" for r in some]))
                sides.append(rows.select(*LAKE_SCHEMA.names, F.substring_index("_metadata.file_path", "/", -parts).alias("rel")))
        if not sides:
            return spark.createDataFrame([], nullable(LAKE_SCHEMA)).withColumn("rel", F.lit(None).cast("string"))
        return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])

    def read(self, spark: SparkSession, **parts: int) -> DataFrame:
        """The lake's rows; with ``day=4`` and the like only those, from their files alone."""
        live = self.files(spark)
        for name, value in parts.items():
            if name not in LAKE_PARTITIONS:
                raise ValueError(f"not a partition column: {name}")
            live = live.filter(F.col(name) == F.lit(value))
        return self._open(spark, [r.rel for r in live.select("rel").collect()]).drop("rel")

    # -- maintenance ------------------------------------------------------
    def bins(self, files: DataFrame) -> DataFrame:
        """The small files (under half the target) of bins with more than one, with their bin in the hour.

        A bin starts where the sizes so far pass a multiple of the target, so it holds less than one and a half targets."""
        hour = Window.partitionBy(*LAKE_PARTITIONS)
        before = F.sum("bytes").over(hour.orderBy("rel").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
        binned = (files.filter(F.col("bytes") < self.target_bytes // 2)
                  .withColumn("bin", F.floor(before / self.target_bytes).cast("int")))
        together = F.count(F.lit(1)).over(Window.partitionBy(*LAKE_PARTITIONS, "bin"))
        return binned.withColumn("_n", together).filter(F.col("_n") > 1).drop("_n")

    def compact(self, spark: SparkSession) -> int | None:
        """Merge the small files; the new manifest's number, or None where there is nothing to merge."""
        before = self.version(spark)
        version = 0 if before is None else before + 1
        # fixed once: the rows that are rewritten and the files that are retired must be the same
        plan_path, live_path = scratch_path(spark, "bins"), scratch_path(spark, "live")
        self.files(spark).write.parquet(live_path)
        live = spark.read.schema(_NONE).parquet(live_path)
        self.bins(live).write.parquet(plan_path)
        plan = spark.read.schema(f"{_NONE}, bin int").parquet(plan_path)
        chosen = [r.rel for r in plan.select("rel").collect()]
        if not chosen:
            return None
        self._merge(spark, chosen, plan, version)
        self._commit(spark, live, plan, before, version)
        return version

    def _merge(self, spark: SparkSession, chosen: list[str], plan: DataFrame, version: int) -> None:
        rows = self._open(spark, chosen).join(plan.select("rel", "bin"), "rel").drop("rel")
        padded = rows.withColumns({p: F.lpad(F.col(p).cast("string"), 4 if p == "year" else 2, "0") for p in LAKE_PARTITIONS})
        # a bin in one task, as one file; tasks by bytes, but no fewer than cores (files cost time too)
        size = plan.agg(F.sum("bytes").alias("bytes"), F.count_distinct(*LAKE_PARTITIONS, "bin").alias("bins")).first()
        tasks = max(-(-size.bytes // self.target_bytes), min(size.bins, spark.sparkContext.defaultParallelism), 1)
        (padded.repartition(tasks, *LAKE_PARTITIONS, "bin").sortWithinPartitions(*LAKE_PARTITIONS, "bin", "arrival_ts", "event_id")
         .write.mode("overwrite").partitionBy(*LAKE_PARTITIONS, "bin").parquet(f"{self.root}/{_COMPACTED}/v={version}"))

    def _commit(self, spark: SparkSession, live: DataFrame, plan: DataFrame, before: int | None, version: int) -> None:
        gone = plan.select("rel", F.lit(True).alias("gone"))
        files = live.join(gone, "rel", "left").select(
            *_FILE, F.when(F.col("gone"), F.lit(version)).cast("long").alias("retired_in"))
        every = self._list(spark, f"{self.root}/{_COMPACTED}", _MERGED_PARTS)
        fresh = every.filter(F.col("rel").startswith(f"{_COMPACTED}/v={version}/"))
        files = files.unionByName(fresh.withColumn("retired_in", F.lit(None).cast("long")))
        if before is not None:  # retired files that are still there must stay known as such
            there = self._own(spark).unionByName(every).select("rel")
            files = files.unionByName(self.manifest(spark, before).filter(F.col("retired_in").isNotNull())
                                      .join(there, "rel", "left_semi"))
        files.write.mode("overwrite").parquet(f"{self.root}/{_MANIFESTS}/v={version}")

    def vacuum(self, spark: SparkSession) -> int:
        """Delete the files retired before the newest manifest and older manifests than the one before it; the number
        of files.  From then on only :meth:`read` reads an archive that has a sink log, which still names them."""
        newest, n = self.version(spark), 0
        if newest is None:
            return 0
        old = self.manifest(spark, newest).filter(F.col("retired_in") < newest).select("rel")
        for row in old.toLocalIterator():
            _delete(spark, f"{self.root}/{row.rel}")
            n += 1
        for v in child_ids(spark, f"{self.root}/{_MANIFESTS}", "v", committed=False):
            if v < newest - 1:
                _delete(spark, f"{self.root}/{_MANIFESTS}/v={v}")
        return n
