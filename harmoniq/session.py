"""Session construction and cluster-facing settings.

The library never builds its own session inside an operator: every operator
takes DataFrames (or a SparkSession) from the caller.  ``build_session`` is
for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at 100 TB as much as on a laptop:
#  * AQE re-plans joins from runtime sizes (broadcast only when the measured
#    side is under autoBroadcastJoinThreshold, sort-merge otherwise), coalesces
#    small shuffle partitions and splits skewed ones.
#  * maxPartitionBytes bounds the scan split size so a task's input fits in
#    executor memory regardless of file size.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "harmoniq", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("HARMONIQ_DRIVER_MEMORY", "16g")))
    for k, v in {**CLUSTER_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system folder and is used
    as is.  Only where it is unset (local tests) do we create one.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext            # not available on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="harmoniq-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for derived tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def to_local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can write small fixture files."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def materialize(df):
    """Cut lineage of a small derived table that feeds several branches of
    one plan: a reliable checkpoint into the shared ``spark.checkpoint.dir``
    (survives executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
