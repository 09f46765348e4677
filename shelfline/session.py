"""Session settings, and where jobs may keep intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # No Python call site per column expression: building a wide plan takes half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_LOCAL_ROOT: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  name: str = "shelfline") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(name)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir`` of the session.

    Only a one-machine session without the setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="shelfline-")
    return _LOCAL_ROOT[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared root that nothing else uses."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage by reliable checkpoints; give them a place."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(new_folder(spark, "checkpoints"))
