"""Spark session set-up and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution (runtime coalescing, skew-join
# splitting, broadcast conversion from real sizes), a fixed time zone so epoch
# <-> text conversions are reproducible, and no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(app: str = "strata", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (a cluster passes its own conf)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STRATA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: float, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a cluster run, from the bytes scanned and the cores available.

    Scan splits of ``target_partition_bytes`` keep a task's input well inside an
    executor's memory share; the initial shuffle partition count is the larger of
    3 waves of cores and input / target, and AQE coalesces small ones at runtime
    toward the advisory size.  At 100 TB and 8,000 cores: 409,600 shuffle partitions.
    """
    shuffle = max(3 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, and where the setting is absent, is a scratch folder made; on a
    cluster such a folder would lie on each machine's own disk, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="strata-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints."""
    return ensure_checkpoint_dir(spark)
