"""SparkSession construction and the shared working folder.

Jobs never choose a machine-local folder on a cluster: results that must
outlive a stage (persisted Top-N tables, stream checkpoints, idempotent
delta tables) go under the folder named by ``spark.checkpoint.dir``.
Only when the session has none (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes that depend on the cluster
# (shuffle partitions, file split size) are left to the caller.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Profile for a large cluster (~1000 executors, ~100 TB inputs). Shuffles
# start wide and AQE coalesces them to ~256 MB partitions, so no single
# setting has to fit both a 5-row dimension and a 100 TB fact table; skewed
# partitions over 5x the median (and 512 MB) are split; input splits stay at
# 256 MB so a task's working set fits executor memory; the streaming state
# lives in RocksDB (off-heap, spills to local disk) instead of the JVM heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # the static size check sees compressed parquet bytes; count them 4x so a
    # table that decompresses large is not taken for a small one (AQE's
    # runtime conversion uses the exact shuffle sizes)
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.speculation": "true",
}


def build_session(master: str | None = None, app_name: str = "footfall",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  profile: str = "local") -> SparkSession:
    """``profile="cluster"`` adds ``CLUSTER_CONF``; ``extra`` wins over both."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    for k, v in conf.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Text dates in outputs are rendered in UTC, like the oracle."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Without
    one, a private folder is made if the master is local (tests); on a cluster
    executors could not share it, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="footfall-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    root = root.rstrip("/")
    return "/".join([root, *[p.strip("/") for p in parts]]) if parts else root


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder for one run (streams get their own checkpoints)."""
    import uuid
    return shared_dir(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so the path can be used by local tools."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
