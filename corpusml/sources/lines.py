"""Line-numbered text: the manifest and label files.

``id`` is the 0-based line number in file order, as ``textFile`` +
``zipWithIndex`` would give, but computed with DataFrame operations so that
a file of any size is numbered in parallel:

1. scan the file(s) line by line (Hadoop line reader: ``\\n``, ``\\r\\n`` or
   ``\\r`` end a line; a final line break adds no empty line);
2. tag each row with its split (``_metadata.file_path``,
   ``_metadata.file_block_start``) and ``monotonically_increasing_id()``,
   which increases by one per row inside a task;
3. per split: row count and first id (one row per split, tiny);
4. running sum of the counts in (file, split start) order = offset of the
   split; line number = offset + id - first id.

Step 4 touches one row per input split and is joined back; AQE turns that
join into a broadcast at run time when the table is small, without a size
guess made here.  Several files are numbered one after another in path order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path) -> DataFrame:
    """``DataFrame[id bigint, line string]`` for a text file (or files)."""
    raw = spark.read.text(str(path) if not isinstance(path, (list, tuple)) else [str(p) for p in path])
    tagged = raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    splits = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_block", "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (tagged.join(splits, ["_file", "_block"])
            .select((F.col("_offset") + F.col("_row") - F.col("_first")).alias("id"), "line"))


def split_lines(text) -> Column:
    """Lines of an in-memory text as an array, with the same line rules as
    the file reader (``\\r\\n``, ``\\n``, ``\\r``; a final break adds no line)."""
    text = F.col(text) if isinstance(text, str) else text
    body = F.regexp_replace(text, r"(\r\n|\n|\r)$", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(body, r"\r\n|\n|\r"))


def explode_lines(df: DataFrame, text_col: str, keys: list[str]) -> DataFrame:
    """One row per line: ``keys + [line_no bigint, line string]``."""
    return df.select(*keys, F.posexplode(split_lines(text_col)).alias("line_no", "line")) \
             .withColumn("line_no", F.col("line_no").cast("bigint"))
