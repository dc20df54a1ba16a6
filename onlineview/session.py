"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. Session time zone is pinned so text encodings of
# timestamps do not depend on the machine; AQE re-plans joins and partition
# counts from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
}


def scale_conf(input_bytes: int, *, executors_cores: int, target_partition_bytes: int = 256 << 20,
               streaming_state: bool = False) -> dict[str, str]:
    """Settings sized from the input, for large clusters (pass to the builder).

    Scan splits of ``target_partition_bytes``; an initial shuffle width that
    keeps each reducer's share near that size even before AQE coalesces
    (at least 2 tasks per core); AQE skew splitting for joins and rebalances;
    RocksDB state for streaming groups with many entities.
    """
    width = max(2 * executors_cores, input_bytes // target_partition_bytes)
    conf = {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    if streaming_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = \
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "onlineview",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("ONLINEVIEW_DRIVER_MEMORY", "8g"))
         # local runs only: a fresh folder stands in for the cluster's shared one
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="onlineview-ckpt-")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """AQE is on for plans made within, as in ``foreachBatch``, whose session has it off. Without it Spark drops REBALANCE hints."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, creating a local one only for a local master.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS, object
    store): a machine-local one would be a different folder on every executor.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="onlineview-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/onlineview/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors of a session in which it is not installed.

    The Python data source and batch functions are unpickled on the workers by module name. Once per application.
    """
    import shutil
    import sys

    sc = spark.sparkContext
    if getattr(sc, "_onlineview_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="onlineview-src-")
    stage = os.path.join(folder, "src")
    skip = shutil.ignore_patterns("__pycache__", "*.pyc")
    shutil.copytree(os.path.join(top, "onlineview"), os.path.join(stage, "onlineview"), ignore=skip)
    before = list(sys.path)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "onlineview_src"), "zip", stage))
    sys.path[:] = before  # the driver goes on using what it has imported
    shutil.rmtree(stage)
    sc._onlineview_shipped = True
