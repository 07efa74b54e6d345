"""Session construction and shared scratch space.

Everything the library writes (landing zones, stream checkpoints, change logs,
staging tables) lives under the folder the cluster names in
``spark.checkpoint.dir``. Without that setting a session on a cluster gets an
error; only a single-process ``local[...]`` session (tests) falls back to a
temporary folder, which all its threads share.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts at
# runtime from real shuffle sizes and splits skewed join partitions; UTC keeps
# date derivations stable across executors.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL_ROOT: str | None = None


def is_local(master: str) -> bool:
    """One JVM: every task sees the driver's folders."""
    return master == "local" or master.startswith("local[")


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the session comes from the launcher."""
    global _LOCAL_ROOT
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    if extra:
        conf.update(extra)
    if "spark.checkpoint.dir" not in conf and is_local(master):
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="strata-")
        conf["spark.checkpoint.dir"] = os.path.join(_LOCAL_ROOT, "checkpoints")
        conf.setdefault("spark.sql.warehouse.dir", os.path.join(_LOCAL_ROOT, "warehouse"))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(executors: int, cores_per_executor: int,
                 executor_memory_gb: int = 32) -> dict:
    """Settings for a large cluster (pass to the launcher / builder).

    Shuffle partitions start at ~3 waves of the cluster's cores and AQE
    coalesces them towards 256 MB; scans split files at 256 MB; skewed join
    and rebalance partitions are split at runtime; the planner may broadcast
    a side only when its estimated size is under 64 MB (and AQE re-checks the
    real size); streaming state lives in RocksDB, off the JVM heap.
    """
    cores = executors * cores_per_executor
    return {
        **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.sql.execution.arrow.pyspark.enabled"},
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.executor.memory": f"{executor_memory_gb}g",
        "spark.executor.cores": str(cores_per_executor),
    }


def shared_root(spark: SparkSession) -> str:
    """Shared folder for library-owned data: ``spark.checkpoint.dir``."""
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark.conf.get("spark.master")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="strata-")
    return _LOCAL_ROOT


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    return f"{shared_root(spark)}/strata/{tag}-{uuid.uuid4().hex[:12]}"
