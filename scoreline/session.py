"""Session helpers.

On a cluster the session is whatever ``getOrCreate`` hands back (cluster tuning
wins). Local defaults are applied only when no session exists yet, which is the
case in tests and in ``bench.py``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: the static planner's estimate comes
    # from compressed file sizes and happily broadcasts a fact table; AQE
    # decides from the actual shuffle output of a side instead.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of materialized intermediates go once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def get_spark(cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.master(f"local[{cores}]").appName("scoreline")
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    n = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = builder.config("spark.sql.shuffle.partitions", str(n))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executor_cores: int = 4, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume (pass to spark-submit --conf).

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    of the widest shuffle (the line-item side of the match derivation, at most
    the input), AQE then coalesces small ones and splits skewed ones; scan
    splits match the same target. Broadcasts happen only from measured sizes.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.executor.cores": str(executor_cores),
        # shuffle files outlive a lost executor when an external shuffle service runs
        "spark.shuffle.service.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.speculation": "true",
        # state of streaming operators lives on disk, not in the executors' heap
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def shared_dir(spark: SparkSession) -> str:
    """Base folder all executors can reach: the session's checkpoint dir.

    A cluster names it in ``spark.checkpoint.dir``; we only invent one (a fresh
    local folder) when running in local mode with the setting unset.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    base = tempfile.mkdtemp(prefix="scoreline-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder."""
    return f"{shared_dir(spark)}/scoreline/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the query that wrote them ends; else they stay until the driver collects its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` hold for the session inside; then what was set before holds again."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
