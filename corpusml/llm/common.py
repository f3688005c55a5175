"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.session import checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it
    back: lineage is cut, a lost executor costs nothing that was written,
    and every later reader sees the same rows (row numbers, layouts)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/corpusml-llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` of which everything made from them
    has been materialized too, so that nothing will ever read them again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Largest table that is broadcast, by the sum of its rows' widths.
BROADCAST_BYTES = 32 << 20


def is_bounded(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` (a written table, or columns of one) are
    at most ``limit`` bytes: measured, not estimated."""
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else F.lit(8)
                 for c, t in df.dtypes), F.lit(24))
    return (df.agg(F.sum(width)).first()[0] or 0) <= limit


def bounded(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for a broadcast if it is small, else for a merge join."""
    return F.broadcast(df) if is_bounded(df, limit) else df.hint("merge")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many leading ``_`` as make it new to ``df``."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


#: Rows of an Arrow batch; texts are long rows, and two copies of a batch are in memory at a time.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings that the Python parts of these operators rely on.

    Python workers get this checkout on their path (a cluster installs the
    package or ships it with ``--py-files``; then this adds nothing), and
    rows go to them in batches of at most ``BATCH_ROWS``."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, str(BATCH_ROWS))
