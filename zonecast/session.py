"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "zonecast",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1 << 20


def scale_conf(input_bytes: int, executor_memory_gb: float = 16.0, executor_cores: int = 4) -> dict[str, str]:
    """Partition sizing for a large run, from the input size and executors.

    * Scans split at <= 256 MB (compressed parquet expands 3-5x in memory),
      less when a core's share of executor memory is small.
    * Shuffles start with one partition per ~64 MB of input (at least 200,
      at most 200,000) and AQE coalesces them towards 128 MB, so a stage
      never has partitions larger than a core's memory share, even before
      map-side aggregation shrinks the data.
    * Skewed partitions above 256 MB (and 5x the median) are split by AQE;
      broadcasts stay capped at 64 MB per measured side.
    * Small files (one daily CSV per station and year, tens of KB) are packed
      many per task: a 1 MB open cost instead of 4 MB cuts the task count of
      a small-file scan about fourfold.
    """
    per_core_mb = executor_memory_gb * 1024 / max(executor_cores, 1)
    split_mb = int(max(32, min(256, per_core_mb / 8)))
    shuffle_parts = int(min(200_000, max(200, input_bytes // (64 * MB))))
    return {
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.files.openCostInBytes": "1m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a session whose driver and
    executors are one process (``local[...]``) gets a folder of its own;
    a cluster session raises, since its executors do not share local disks.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="zonecast-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/zonecast-scratch/{name}-{uuid.uuid4().hex}"
