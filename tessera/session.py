"""Session settings the operators are designed for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions (one tenant or key may hold a third of the rows), switch a join to
# broadcast when a shuffle stage turns out small.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Building the wide merge projections is thousands of Column calls; the
    # per-call Python call-site capture (a debugging aid) multiplies their cost.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_conf(largest_shuffle_bytes: int, executor_cores: int, executors: int,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the largest shuffle of a call.

    A large-batch merge shuffles the target's rows once; the shuffle is cut into
    partitions of about ``partition_bytes`` (AQE coalesces the small ones and
    splits skewed ones), and never fewer partitions than task slots.  Example:
    100 TB over 1000 executors x 8 cores -> 400k shuffle partitions of 256 MB.
    """
    slots = executor_cores * executors
    parts = max(slots, -(-largest_shuffle_bytes // partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # Spark broadcasts on its own only what its estimate proves small.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder every executor
    can reach; it is read, never overridden.  Where none is set, a run in one
    local process (tests) gets a fresh temporary folder and a cluster an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    return path
