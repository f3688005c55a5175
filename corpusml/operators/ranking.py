"""Exact global ranking without a single-task gather.

``orderBy(...).limit(k)`` keeps k rows per partition and merges
``partitions x k`` rows in one task; a ranking window without
``partitionBy`` moves every row into one task.  ``global_rank`` instead

1. range-partitions the rows on the sort key into a fixed number of
   partitions and sorts inside each (partition i holds only keys below
   partition i+1's);
2. counts rows per partition — one row per partition — and turns the counts
   into offsets with a running sum over that tiny table;
3. rank = offset of the partition + position inside it
   (``monotonically_increasing_id`` increases by one per row in a task).

Range bounds come from a sample drawn per exchange, so the tagged rows are
written once (as Parquet below ``spark.checkpoint.dir``) before their two
uses: counts and rows then come from the same frozen layout and ids, and the
lineage above it is cut.  The table ranked here is an aggregate (e.g. one
row per term), not the corpus; leaving the ``with`` block deletes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusml.session import checkpoint_dir


@contextmanager
def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                limit: int | None = None, num_partitions: int | None = None) -> Iterator[DataFrame]:
    """``df`` plus a 0-based ``rank_col`` (bigint) in the total order
    ``order`` (which must break all ties); ``limit`` keeps ``rank < limit``.
    The ranked rows are valid inside the ``with`` block."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{checkpoint_dir(spark)}/corpusml-rank-{uuid.uuid4().hex}"
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_part", F.spark_partition_id())
     .withColumn("_row", F.monotonically_increasing_id())
     .write.parquet(folder))
    try:
        tagged = spark.read.parquet(folder)
        parts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        # One row per partition.
        parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        ranked = tagged.join(parts, "_part").withColumn(
            rank_col, (F.col("_offset") + F.col("_row") - F.col("_first")).cast("bigint"))
        if limit is not None:
            ranked = ranked.where(F.col(rank_col) < limit)
        yield ranked.drop("_part", "_row", "_first", "_offset")
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
