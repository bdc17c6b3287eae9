"""Session helpers.

The library never creates scratch space on a machine-local disk on its own: all
intermediate tables go below ``spark.checkpoint.dir``, the shared folder the
cluster names.  Only when that setting is absent (local tests) a private folder
is created and registered as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(
    master: str | None = None, shuffle_partitions: int | None = None, extra_conf: dict[str, str] | None = None
) -> SparkSession:
    """Return the active session or build a local one with AQE switched on."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("lakeload")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only where it is unset."""
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        # Executors of a cluster do not see this machine's folders.
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakeload-ckpt-")
        try:
            spark.conf.set(_CHECKPOINT_KEY, root)
        except Exception:  # noqa: BLE001 - some sessions refuse runtime core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh, unique folder below the checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/lakeload/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings that keep shuffle and scan partitions at a size one task can hold.

    The initial shuffle partition count is sized so that the largest shuffle (about
    the input size) gives ``target_partition_bytes`` per partition, rounded up to a
    multiple of the cluster's cores; AQE then coalesces small ones and splits skewed
    ones.  Example: 100 TB on 1000 executors x 8 cores -> 416,000 initial shuffle
    partitions of ~256 MB, scans split at 256 MB.
    """
    per_core_rounds = max(1, -(-input_bytes // (target_partition_bytes * max(total_cores, 1))))
    partitions = max(total_cores, per_core_rounds * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 4),
    }
