"""Session helpers: the shared work folder and a local session for tests and benches.

Library code never creates a session; it takes the caller's ``spark``. Everything that
must be written mid-job (raw landings, staged upserts, published exports) goes under the
folder the cluster names in ``spark.checkpoint.dir``. Only a local-mode session without
that setting gets a private folder, so tests run anywhere.
"""
from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local sessions."""
    root = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            # getCheckpointDir() appends a per-application UUID folder; use its parent.
            root = current.rsplit("/", 1)[0]
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set: a cluster session must name a shared folder "
                "(e.g. on HDFS or an object store) for staging and checkpoints"
            )
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root for one job step."""
    return f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """Catalog-safe unique identifier (tables, views, databases)."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches: UI off, UTC, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-wh-"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


_CONF_LOCK = threading.RLock()


class conf_override:
    """Temporarily set session SQL confs; the previous values are restored on exit,
    also when the body raises.

    Some write semantics exist only as session confs (``insertInto`` ignores a
    writer-level ``partitionOverwriteMode``), so the body runs under a process-wide
    lock: two threads using one session cannot interleave their settings."""

    def __init__(self, spark: SparkSession, settings: dict[str, str]):
        self.spark, self.settings, self.saved = spark, settings, {}

    def __enter__(self):
        _CONF_LOCK.acquire()
        for k, v in self.settings.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, str(v))
        return self.spark

    def __exit__(self, *exc):
        try:
            for k, old in self.saved.items():
                if old is None:
                    self.spark.conf.unset(k)
                else:
                    self.spark.conf.set(k, old)
        finally:
            _CONF_LOCK.release()
        return False


MB = 1024 * 1024


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * MB, shuffle_fraction: float = 0.25,
               max_shuffle_partitions: int = 50_000) -> dict[str, str]:
    """Session settings sized for the data, to pass to the cluster's session builder.

    * scan splits of ``2 x target`` bytes (fewer, larger read tasks over huge inputs;
      parquet row groups still bound memory per task);
    * initial shuffle partitions from the *shuffled* volume (``shuffle_fraction`` of
      the input: projections and partial aggregates shrink it), at least 2 waves of
      the cluster's cores and at most ``max_shuffle_partitions`` (map x reduce segment
      counts grow quadratically); AQE then coalesces to ``target`` sized partitions;
    * AQE skew-join splitting on, with a threshold of ``target``;
    * broadcast only for measured sides under 64 MB.
    """
    slots = max(1, executors * cores_per_executor)
    wanted = -(-int(input_bytes * shuffle_fraction) // target_partition_bytes)
    shuffle_parts = max(2 * slots, min(max_shuffle_partitions, wanted))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.files.maxPartitionBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a staging folder this package created (``workspace`` paths only).

    Called after an operation has fully consumed its staged copy; on failure the
    copy is kept for inspection or recovery. Uses the Hadoop FileSystem of the path,
    so it works on HDFS and object stores as well as local disks."""
    root = f"{shared_root(spark)}/strata/"
    if not path.startswith(root) or "/.." in path:
        raise ValueError(f"refusing to delete {path!r}: not a strata staging folder")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (compressed, as written), from the FileSystem's
    content summary: a measured size, e.g. for a broadcast decision."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())
