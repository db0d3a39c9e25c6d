"""Session helpers: configuration defaults and the shared folder for
intermediate tables.

Nothing a cluster has configured is overridden: SQL defaults are set only
where the session has no value, and memory or UI settings are given for
local runs alone.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where the session has no value of its own.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tallyspark") -> SparkSession:
    """The active session, or a new one. ``master`` and ``shuffle_partitions``
    are for local runs; on a cluster leave both to its configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        builder = (builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
                   .config("spark.driver.memory", os.environ.get("TALLYSPARK_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    if not given.contains("spark.sql.shuffle.partitions") and (shuffle_partitions or master):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, TALLYSPARK_CHECKPOINT_DIR names one; a single-process
    local run gets a temporary folder of its own. On a cluster without either
    this is an error: a machine-local folder would lose other executors' files.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or os.environ.get("TALLYSPARK_CHECKPOINT_DIR")
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir (or TALLYSPARK_CHECKPOINT_DIR) to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tallyspark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint folder and read it
    back: a lineage cut that outlives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tallyspark-stored/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
