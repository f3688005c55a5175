"""Session helpers for tests, the bench and local runs.

Library functions never create a session: they take the caller's.  On a
cluster, ``spark.checkpoint.dir`` names the shared folder for lineage cuts;
``checkpoint_dir`` reads it and only invents a local folder when it is
unset on a ``local[...]`` master (local runs and tests); on a cluster an
unset folder is an error, never a machine-local default.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "corpusml", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        # A machine-local folder would not survive the loss of the executor
        # that wrote it: a cluster must name a shared one.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster")
    local = tempfile.mkdtemp(prefix="corpusml-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    _delete_at_end(spark, local)
    return local


def _delete_at_end(spark: SparkSession, folder: str) -> None:
    """Hadoop deletes ``folder`` when the driver's file systems are closed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, shared by all executors,
    for files that a returned DataFrame may still read: it is deleted when
    the application ends."""
    folder = f"{checkpoint_dir(spark)}/corpusml-{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)  # only what exists can be registered
    _delete_at_end(spark, folder)
    return folder


def written(df, name: str):
    """``df`` written as Parquet to a scratch folder and read back: it is
    computed once, and a lost executor costs nothing that was written."""
    folder = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def package_on_workers(spark: SparkSession) -> None:
    """Python workers import this package from the driver's checkout, unless
    a cluster has installed it (then this adds a path that is not there)."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
