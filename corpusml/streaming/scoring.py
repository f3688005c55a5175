"""Incremental scoring of document files as they arrive.

Tokenizers are column expressions and fitted models transform row by row,
so the batch scoring plan runs as it is on a file-source stream.  Spark's
file streams skip files of length 0: an empty document gives no row here
(the batch job, which has a manifest to compare with, scores it).
No state is kept (nothing to watermark); each micro-batch reads only new
files and the query's checkpoint location makes it restartable after a
failure.  The joint kind needs two files per document and therefore a
stream-stream join; it is left to the batch job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.sources.corpus import normalize_base, tokenize


def document_stream(spark: SparkSession, base, kind: str = "bytes",
                    vocabulary: Iterable[str] | None = None, lowercase: bool = False,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``[hash, url, features]`` over ``{base}/{kind}/*.{kind}``."""
    if kind not in ("bytes", "asm"):
        raise ValueError("streaming supports kind 'bytes' or 'asm'")
    reader = spark.readStream.option("pathGlobFilter", f"*.{kind}")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.text(f"{normalize_base(base)}/{kind}", wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*)\.{kind}$", 1)
    return raw.select(name.alias("hash"), F.col("_metadata.file_path").alias("url"),
                      tokenize("value", kind, vocabulary, lowercase).alias("features"))


def score_stream(fitted, stream: DataFrame) -> DataFrame:
    """``[hash, prediction, predictedClass]`` for each arriving document,
    using a ``FittedClassifier`` from ``corpusml.plans.jobs``."""
    return fitted.score(stream, labelled=False).select("hash", "prediction", "predictedClass")
