"""Session construction and shared-storage helpers.

Everything that writes intermediate data (CSV round trips, saved models,
metric sinks, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``.  On a cluster that folder is shared storage, so a
lost executor never loses the only copy of an intermediate result.  A
private folder is made only in local mode when the setting is absent; any
other master without it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Fixed session defaults; scale-dependent knobs are left to the cluster.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # lineage cuts are written to shared storage; delete them once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "tabula",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            # a private folder would scatter the parts over the machines' own disks
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        conf_dir = tempfile.mkdtemp(prefix="tabula-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver did.

    Only needed by operators that run Python in tasks; a cluster that installs
    the library on its machines ignores the extra path.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}")



def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps, and re-run tasks,
    see the same rows in the same parts, and losing an executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
