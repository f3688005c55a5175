"""Inverse document frequency and TF-IDF in long form.

``idf(t) = ln((m + 1) / (df(t) + 1))`` with ``m`` training rows, the
smoothed form of ``pyspark.ml.feature.IDF`` (minDocFreq 0).  The vector form
is ``IDF`` itself inside a ``FeaturePipeline``; the long form below serves
reports and checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.operators.matching import salted, with_salt


def idf_weights(vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """``[term, df, idf]`` for a vocabulary built on ``n_docs`` rows."""
    return vocabulary.select("term", "df", F.ln(F.lit(n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(counts: DataFrame, idf: DataFrame, id_col: str = "id") -> DataFrame:
    """Long-form counts ``[..., term, cnt]`` times idf: adds ``tfidf``.
    Frequent terms are split over join partitions."""
    weights = salted(idf.select("term", "idf"))
    return with_salt(counts, id_col).join(weights, ["term", "_salt"]).select(
        *counts.columns, "idf", (F.col("cnt") * F.col("idf")).alias("tfidf"))
