"""Session construction and shared scratch locations.

Library code never creates a session: callers pass ``spark``. ``local_session``
is for tests and the bench only.

Scratch data (stream checkpoints, replay files, estimator samples, lineage
rounds) lives under the cluster's shared ``spark.checkpoint.dir``. Only when the
session has none and its master is ``local`` is a fresh directory created and
registered; on a cluster, where executors would not see it, a missing setting
is an error.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "riskflow") -> SparkSession:
    """A local session shaped like a small cluster: AQE on, UI off, UTC."""
    if shuffle_partitions is None:
        shuffle_partitions = int(cores) if str(cores).isdigit() else 8
    parts = shuffle_partitions
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session, set only when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # a bare local run (tests): one process, so a folder of its own is shared
        configured = tempfile.mkdtemp(prefix="riskflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/riskflow/{name}-{uuid.uuid4().hex[:12]}"


def sf_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def cluster_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20,
                 min_partitions: int = 200) -> dict[str, str]:
    """Settings for a large cluster, sized from the expected shuffle volume.

    Shuffle partitions are fixed for stateful streaming queries (they are kept
    in the checkpoint), so they are sized up front from the data volume, about
    ``partition_bytes`` each; AQE coalesces small ones and splits skewed ones
    in batch jobs. Pass the result to ``SparkSession.builder.config(map=...)``.
    """
    parts = max(min_partitions, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.dynamicAllocation.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


@contextlib.contextmanager
def state_partitions(spark: SparkSession, input_bytes: int, partition_bytes: int = 32 << 20, least: int = 4):
    """Start stateful streams with a partition count taken from the volume to come.

    A stateful query keeps the count of its first start for life, so it must
    follow the data expected, not the cores that happen to be registered: one
    partition per ``partition_bytes`` of (compressed) input. The session's
    setting is restored after the block.
    """
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(max(least, -(-int(input_bytes) // partition_bytes))))
    try:
        yield
    finally:
        spark.conf.set(key, old)
