"""Session construction and the shared scratch folder.

On a cluster, scratch data (replay files, lake copies, serving tables,
streaming checkpoints) lives under the shared folder named by
``spark.checkpoint.dir``.  A local folder is chosen only when the session has
none, which is the case in tests and local benches.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for a session built by this package (tests, bench, examples).  On a
# cluster the deployment supplies its own; these are the ones that matter.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a changelog per micro-batch instead of a full RocksDB snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "eventlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are UTC instants; windows and partition parts assume it."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_local_root: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, choosing a local one only if unset.

    The session's ``spark.checkpoint.dir`` wins, then the SparkContext's
    checkpoint dir; only when neither exists (a bare local session) is a
    local folder created, once per process, and registered with the context.
    """
    global _local_root
    root = spark.conf.get(CHECKPOINT_CONF, None)
    sc = getattr(spark, "sparkContext", None)
    if not root and sc is not None:
        try:
            root = sc.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="eventlens-ckpt-")
        root = _local_root
        try:
            spark.conf.set(CHECKPOINT_CONF, root)
        except Exception:  # a core config may be read-only at runtime
            pass
    if sc is not None:
        try:
            if not sc.getCheckpointDir():
                sc.setCheckpointDir(root)
        except Exception:
            pass
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/eventlens/{kind}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tests can inspect written files."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
