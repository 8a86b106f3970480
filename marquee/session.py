"""Session defaults and the shared scratch location.

Every function in the library is zone-free and ANSI-safe (``try_cast``), so it gives the same rows under any
session; the builder below only sets what makes plans good: AQE with skew-join splitting, UTC, no UI.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


PARTITION_BYTES = 256 << 20


def cluster_settings(total_cores: int, shuffle_bytes: int = 0) -> dict[str, str]:
    """Sizing for a large cluster (e.g. 1000 executors x 8 cores over 100 TB).

    AQE joins small shuffle partitions but does not split ordinary ones, so the number at the start is sized from the
    largest shuffle expected: ``shuffle_bytes`` / 256 MB, and at least 4 per core. AQE coalesces smaller shuffles to
    ~256 MB. Scans split at 256 MB; a shuffle partition over 512 MB and 5x the median is split by the skew join.
    """
    partitions = str(max(4 * total_cores, -(-shuffle_bytes // PARTITION_BYTES)))
    return {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def build_session(
    master: str | None = None,
    app_name: str = "marquee",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    total_cores: int | None = None,
    shuffle_bytes: int = 0,
) -> SparkSession:
    """``total_cores`` and ``shuffle_bytes`` apply ``cluster_settings``; ``shuffle_partitions`` and ``extra`` override."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if total_cores:
        conf.update(cluster_settings(total_cores, shuffle_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One process on one machine; ``local-cluster[...]`` runs executors of its own and counts as a cluster."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set on the context so ``checkpoint()`` and ALS use it.

    Only a local session without the setting gets a private folder under the temp dir (tests). A cluster
    session without it is an error: a machine-local folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context here; the server's setting is the only one
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the Spark Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured is None and current is None:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster")
        configured = tempfile.mkdtemp(prefix="marquee-ckpt-")
    if current is None:
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for written intermediate tables."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/marquee-scratch/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders that this process handed out, through Spark's file system; results that still read
    from them must have been written elsewhere. Returns how many were there."""
    removed = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed
