"""The corpus pipeline: toxicity filter, line dedup, SimHash near-dedup,
benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``, calls one operator on all rows
its predecessor kept and acts on its result; all but the last return the
columns of ``documents``.  ``run`` writes every stage's result as Parquet to
the shared checkpoint folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.llm import decontaminate, linededup, packing, simhash, toxicity
from corpusml.llm.common import prepare, materialize, table, text_or_empty
from corpusml.llm.registry import TOXIC_FROM, toxicity_model

#: A trained classifier and a tokenizer have no SQL form.  The tests hold each
#: stage to its operator; the operators have brute-force tests of their own.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold stay."""
    prepare(spark)
    model = toxicity_model(spark, docs, sf_dir)
    return docs.where(toxicity.score_column(spark, model) < TOXIC_FROM)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; a document that
    loses all its lines goes.  ``n_chars`` follows the text."""
    prepare(spark)
    cut = linededup.dedup_lines(docs)
    n_lines, n_removed, _ = linededup.count_columns(docs)
    changed = F.col(n_removed) > 0
    kept = cut.where(F.col(n_removed) < F.col(n_lines))
    length = F.when(changed, F.length(text_or_empty("text"))).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).drop(
        *linededup.count_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    prepare(spark)
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of everything kept into sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage_{k}")
    return docs
