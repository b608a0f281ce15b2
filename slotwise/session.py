"""Session helpers.

Library code never creates a session on its own; it only reads settings from
the session it is given.  ``local_session`` exists for tests and ``bench.py``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session used with this package should carry.  AQE re-plans
# joins and shuffle partition counts at runtime from measured sizes, which is
# what keeps a plan sane when a device or an hour bucket holds far more rows
# than its neighbours.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("slotwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    # Tests only: a cluster names its shared folder in spark.checkpoint.dir.
    if not os.environ.get("SLOTWISE_CHECKPOINT_DIR"):
        os.environ["SLOTWISE_CHECKPOINT_DIR"] = tempfile.mkdtemp(prefix="slotwise-ckpt-")
    builder = builder.config("spark.checkpoint.dir", os.environ["SLOTWISE_CHECKPOINT_DIR"])
    # quiet a pandas deprecation notice printed by Python workers on every batch
    os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (never a local default)."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        # Unset: only a local test session gets here (a cluster names a shared
        # folder).  Refuse to invent a machine-local folder on a cluster.
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        configured = tempfile.mkdtemp(prefix="slotwise-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch(spark: SparkSession, prefix: str) -> str:
    """A new folder name under the shared checkpoint folder; removed when the session's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/slotwise-{prefix}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)        # only what exists can be marked
    fs.deleteOnExit(p)
    return path


def cluster_conf(input_bytes: int, executor_cores: int = 4, target_partition_bytes: int = 128 << 20) -> dict:
    """Settings to size a cluster session for ``input_bytes`` of input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (AQE coalesces small ones and splits skewed ones at runtime), scans
    split at the same size, and device-keyed inventories get a bucket count
    of the same order so their joins and windows stay shuffle-free.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    # inventories are a small share of the input: ~parts/4 buckets
    buckets = 1 << max(3, (parts - 1).bit_length() - 2)
    return {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.executor.cores": str(executor_cores),
        "slotwise.buckets": str(buckets),
        # state of streams on the executors' disks, not in their heaps
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
