"""Session helpers: shared scratch space and the confs the library relies on.

The library never creates a session for the caller; it only reads what the
session says. The one place where a folder is needed (lineage cuts, staged
writes, streaming checkpoints) is taken from ``spark.checkpoint.dir``, which on
a cluster names a shared file system. A folder of our own is set only when the
session has none, as in unit tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

EVENTS_MS = 10_000

# Confs that the plans in this package assume. Callers that own the session
# (bench, tests) apply them; library code reads, never overrides.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    # the keys of a streaming dedup's horizon need not fit the executors' heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged data.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir``; only
    when both are unset a local session gets a temporary folder; elsewhere this
    raises, as executors would not see each other's files.
    """
    root = _context_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        root = None
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect its garbage, so that Spark's cleaner drops the shuffle files of
    done steps. Pending listener events hold their plans, so they are waited for, up to ``EVENTS_MS``."""
    for pause in (0.0, 1.0):
        time.sleep(pause)
        with contextlib.suppress(Py4JError):
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(EVENTS_MS)
        spark._jvm.System.gc()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own (a ``scratch_path``) on whatever file system holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def apply_recommended_conf(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and the local bench (never used by library code)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_recommended_conf(spark)
    # Local data is tiny: let AQE keep more, smaller partitions so writes of
    # many small day folders run on all cores (no effect on large data).
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    # Listing thousands of partition folders runs as a Spark job with one task
    # per folder by default; on 8 local cores a few dozen tasks are faster
    # (on a cluster, size this to the executor cores).
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "64")
    # Nesting keeps bounded arrays per group; let the object hash aggregate
    # hold more groups per task before it falls back to sorting.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
    checkpoint_root(spark)
    return spark
