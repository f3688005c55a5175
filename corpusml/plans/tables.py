"""The driver's parquet tables as a document corpus.

``documents`` plays the document collection: its ``lang`` is the class, its
text is seen through the two document kinds of the classifier — a hex dump
of the UTF-8 bytes (``bytes``) and an assembly-style listing of its lines
(``asm``).  ``labels`` is a second label source (``quality``), ``benchmark``
a second corpus.

Train / test split used by every query: ``doc_id % 5 <> 0`` trains,
``doc_id % 5 = 0`` tests; together they are the whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.functions.batches import dumped_byte_tokens
from corpusml.functions.tokens import add_ngrams, join_token_lists, joint_tokens, with_line_break
from corpusml.functions.views import asm_listing, hex_dump
from corpusml.sources.corpus import tokenize

TEST_FOLDS = 5
#: A table of up to one scan task's bytes (Spark's default) is read in so many slices at most.
ONE_TASK_BYTES, MAX_SLICES = 128 << 20, 16
# The word vocabulary of the listing view (frequent short words
# of the four languages in ``documents``).
LISTING_WORDS = (
    "a and are as at be by das de der des die du el en for from il in is la las le les los mit of on para por que "
    "sur the to un una und une von was with zu"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_scan(df: DataFrame, key: str) -> DataFrame:
    """``df`` read in several slices if it is one scan task's worth of data
    at most and gives fewer partitions than there are cores (a table stored
    as one row group is one task).  Slices are filters on the scan, so
    nothing is shuffled and no layout is promised to later operators; each
    reads the file, which ``MAX_SLICES`` and the size bound.  Any larger
    table has a scan of many tasks and is left alone."""
    spark = df.sparkSession
    n = min(spark.sparkContext.defaultParallelism, MAX_SLICES)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > ONE_TASK_BYTES or df.rdd.getNumPartitions() >= n:
        return df
    share = F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(n))
    return reduce(DataFrame.unionAll, [df.where(share == k) for k in range(n)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, read in parallel for the CPU-heavy tokenizers."""
    return split_scan(table(spark, sf_dir, "documents"), "doc_id")


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``[id, label]`` of all documents: no text is read."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))


def is_test(id_col: str = "id"):
    return F.col(id_col) % TEST_FOLDS == 0


def split(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    return df.where(~is_test(id_col)), df.where(is_test(id_col))


def corpus(spark: SparkSession, sf_dir: str, kind: str = "bytes", lowercase: bool = False,
           vocabulary=LISTING_WORDS, docs: DataFrame | None = None) -> DataFrame:
    """``[id, label, features]`` for the whole ``documents`` table.  Both
    views of a document come from one row: the joint kind needs no join."""
    docs = documents(spark, sf_dir) if docs is None else docs
    return docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"),
                       token_column(kind, vocabulary, lowercase).alias("features"))


def token_lists(spark: SparkSession, sf_dir: str, kind: str = "bytes", part: str | None = None,
                ngram: int = 1) -> DataFrame:
    """``[id, label, features]`` of the whole ``documents`` table or of one
    ``part`` of the split (``train``, ``test``): the ``ngram``-grams of
    ``corpus``.  Byte tokens are made batch by batch next to the scan
    (``dumped_byte_tokens``), for jobs that read every token; whatever needs
    no tokens is left to ``labels_of``."""
    docs = documents(spark, sf_dir)
    if part is not None:
        docs = split(docs, "doc_id")[("train", "test").index(part)]
    if kind != "bytes":
        return add_ngrams(corpus(spark, sf_dir, kind, docs=docs), ngram)
    return dumped_byte_tokens(docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text"), ngram)


def token_column(kind: str, vocabulary=LISTING_WORDS, lowercase: bool = False, text: str = "text") -> Column:
    """Tokens of a text column seen as ``kind``."""
    if kind != "joint":
        return tokenize(hex_dump(text) if kind == "bytes" else asm_listing(text), kind, vocabulary, lowercase)
    return join_token_lists(joint_tokens(with_line_break(hex_dump(text)), vocabulary, lowercase),
                            joint_tokens(asm_listing(text), vocabulary, lowercase))
