"""Session helpers.

``get_session`` is only a convenience for tests, the bench and scripts; library
functions always take the caller's session and never reconfigure it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Folders that stand in for spark.checkpoint.dir on this machine, by application.
_LOCAL_DIRS: dict[str, str] = {}

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide per-account rows: keep whole-stage codegen on for a few hundred fields.
    "spark.sql.codegen.maxFields": "1000",
    # remove checkpoint files once their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "encore") -> SparkSession:
    """Local session for tests/bench; a cluster job passes its own session."""
    master = master or os.environ.get("ENCORE_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("ENCORE_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name one: executors do not see each other's local folders. Only for a
    ``local[...]`` master a temporary folder stands in where the setting is absent.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if spark.sparkContext.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="encore-ckpt-")
        d = _LOCAL_DIRS[spark.sparkContext.applicationId]
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def scale_conf(input_bytes: float, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a run over ``input_bytes`` of input on ``executor_cores`` cores.

    * shuffle partitions: enough for ~``target_partition_bytes`` per reduce task at the
      largest shuffle (taken as the input size), never fewer than 2 x cores;
      AQE then coalesces small partitions and splits skewed ones at run time;
    * scan splits of ``target_partition_bytes`` so a task's input fits executor memory;
    * broadcast only below 64 MB (estimated) and AQE re-checks real sizes.

    For 100 TB on 1,000 executors x 8 cores this gives ~400k shuffle partitions (AQE coalesces further).
    """
    parts = int(max(2 * executor_cores, input_bytes // target_partition_bytes + 1))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
