"""Documents as tables bucketed by their hash.

Written once, both kinds of a document are in buckets of the same number,
sorted, so a join of the two needs no exchange: neither texts nor token lists
are shuffled, and tokens keep their order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.functions.batches import with_listed_tokens
from corpusml.functions.tokens import prepared, vocabulary_words, with_line_break
from corpusml.sources.corpus import normalize_base, scan_documents
from corpusml.sources.files import document_names


def write_buckets(docs: DataFrame, table: str, path: str, buckets: int) -> None:
    """``docs [hash, text]`` as the external table ``table`` in ``buckets``
    buckets (a bucket is a task's work: some 128 MB).  The texts are shuffled
    this one time, straight into their buckets: one file for each."""
    (docs.select(F.col("hash").cast("string"), F.col("text").cast("string")).repartition(buckets, "hash")
     .write.bucketBy(buckets, "hash").sortBy("hash").option("path", path).mode("overwrite").saveAsTable(table))


def ingest_buckets(spark: SparkSession, base, table: str, path: str, buckets: int,
                   kinds: Iterable[str] = ("bytes", "asm")) -> None:
    """The document files of ``base`` as tables ``{table}_{kind}`` below
    ``path``; a file of length 0 is a row with an empty text."""
    base = normalize_base(base)
    for kind in kinds:
        docs = scan_documents(spark, base, kind)
        # File scans skip files of length 0.
        hollow = document_names(spark, base, kind).select("hash").join(docs.select("hash"), "hash", "left_anti")
        write_buckets(docs.unionByName(hollow.select("hash", F.lit("").alias("text"))), f"{table}_{kind}",
                      f"{path}/{kind}", buckets)


def bucketed_joint_corpus(spark: SparkSession, manifest: DataFrame, table: str, buckets: int,
                          vocabulary: Iterable[str] | None = None, lowercase: bool = False) -> DataFrame:
    """``[id, features, ...]``: joint tokens, in order, of every line of
    ``manifest [id, hash, ...]`` that names a document, from the tables
    ``{table}_bytes`` and ``{table}_asm``.

    Only the manifest is shuffled; both texts stream through the joins and
    are cut batch by batch above them, listed documents only.  Blank lines
    match nothing, repeated hashes give a row for each line, a listed document
    that is in one of the tables only, or in none, fails the job."""
    words = frozenset(vocabulary_words(vocabulary))
    sides = [spark.table(f"{table}_{kind}").select(
        "hash", prepared(with_line_break("text") if kind == "bytes" else "text", lowercase).alias(f"_{kind}"))
        for kind in ("bytes", "asm")]
    wanted = manifest.where(F.col("hash") != "").repartition(buckets, "hash").hint("merge")
    extra = [c for c in manifest.columns if c not in ("id", "hash")]
    found = wanted.join(sides[0], "hash", "left").join(sides[1].hint("merge"), "hash", "left")
    found = with_listed_tokens(found, ["_bytes", "_asm"], lambda: words, pairs=True)
    missing = F.raise_error(F.concat(F.lit("document not found: "), F.col("hash"))).cast("array<string>")
    return found.select(
        "id", F.when(F.col("features").isNull(), missing).otherwise(F.col("features")).alias("features"), *extra)
