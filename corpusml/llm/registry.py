"""Registered queries of the training-data operators: each applies its
operator to its whole table with production parameters and derives the
columns of its contract."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.llm import (
    chat, decontaminate, divergence, licenses, linededup, packing, rankedsearch, secrets, simhash, suffixdedup,
    tokencount, topk, toxicity,
)
from corpusml.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {
    "op2_topk_search": topk.ORACLE,
    "op7_chat_formatting": chat.ORACLE,
    "op8_line_dedup": linededup.ORACLE,
    "op10_benchmark_decontamination": decontaminate.ORACLE,
    "op12_ranked_search": rankedsearch.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}

#: Rows with this remainder of crc32(doc_id as text) modulo 3 are held out.
HELD_OUT = 1
TOXIC_FROM = 0.7


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_topk_search(spark, sf_dir):
    """The five best rows for every vector whose id is divisible by 50."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_suffix_array_dedup(spark, sf_dir):
    """Bytes of every document in 400-byte strings that also start elsewhere."""
    found = suffixdedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def held_out(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % 3 == HELD_OUT


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """The classifier, trained on labels of rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return toxicity.fit(docs.select("doc_id", "text"), labels)


@query
def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    score = toxicity.score_column(spark, toxicity_model(spark, docs, sf_dir))
    scored = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query
def op5_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random")


@query
def op6_token_counts(spark, sf_dir):
    """Unigram token count of every document."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


@query
def op7_chat_formatting(spark, sf_dir):
    """Every conversation from the perspective of each participant."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


@query
def op8_line_dedup(spark, sf_dir):
    """Lines of every document that repeat an earlier three-line window."""
    cut = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_benchmark_decontamination(spark, sf_dir):
    """Benchmark windows found in every document."""
    found = decontaminate.report(*decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op11_license_scan(spark, sf_dir):
    """License phrases and notices in every document."""
    found = licenses.report(*licenses.scan(table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels",
                        "labels", "score")


@query
def op12_ranked_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    found = rankedsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("item_id"), "rank", "doc_id", "score")


@query
def op13_source_divergence(spark, sf_dir):
    """How far the sources of each language lie apart, and in which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))
