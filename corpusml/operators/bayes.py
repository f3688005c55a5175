"""Multinomial naive Bayes.

Training and scoring use ``pyspark.ml.classification.NaiveBayes``: fitting is
one tree-aggregate of (label, vector) sums, scoring is a per-row dot product
against the fitted model (classes x vocabulary, bounded by ``vocabSize``) —
no shuffle at prediction time.

``nb_parameters`` gives the same model as tables (relational form), used for
reports and to check the estimator:

    pi_c        = ln(n_c + lambda) - ln(N + C * lambda)
    theta_{c,t} = ln(tf_{c,t} + lambda) - ln(sum_t tf_{c,t} + V * lambda)

Only observed (class, term) pairs get a row; every other pair of class ``c``
has ``theta = unseen_theta_c = ln(lambda) - ln(sum_t tf_{c,t} + V * lambda)``,
so no class x vocabulary product is ever materialised.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.functions.tokens import explode_tokens
from corpusml.operators.matching import document_terms, salted, with_salt
from corpusml.session import written


def naive_bayes(features_col: str = "features", label_col: str = "indexedLabel",
                smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(featuresCol=features_col, labelCol=label_col, smoothing=smoothing,
                      modelType="multinomial")


def nb_parameters(train: DataFrame, n_terms: int | None = None, vocabulary: DataFrame | None = None,
                  features: str = "features", label_col: str = "indexedLabel",
                  smoothing: float = 1.0, weights: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """``(classes, theta)`` from a labelled token table.

    classes: ``[ix, n_docs, pi, unseen_theta]``; theta: ``[ix, term, tf, theta]``.
    ``n_terms`` is the vocabulary size V (default: the different terms);
    without ``vocabulary`` every term belongs to it; ``weights`` (``[term,
    w]``, e.g. idf) multiplies each count.

    The label travels with the token list, so class-term sums need no join
    with the documents; hot terms are merged map-side by partial
    aggregation.  Texts are tokenized once: the sums per (class, term) are
    written, totals and vocabulary size come from them.  The classes'
    document and token totals (one row per class, as in the label list that
    the model keeps anyway) are collected and enter ``theta`` as constants: a
    class is a hot key that is never joined.
    """
    lam = float(smoothing)
    spark = train.sparkSession
    tokens = explode_tokens(train, features, "term", keep=(F.col(label_col).alias("ix"),))
    if vocabulary is not None:
        tokens = tokens.join(vocabulary.select("term"), "term", "left_semi")
    if weights is None:
        ct = tokens.groupBy("ix", "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    else:
        tokens = tokens.join(weights.select("term", "w"), "term")
        ct = tokens.groupBy("ix", "term").agg(F.sum("w").alias("tf"))
    ct = written(ct, "class-terms")
    if n_terms is None:
        n_terms = ct.select("term").distinct().count()
    docs = {r["ix"]: r["n"] for r in train.groupBy(F.col(label_col).alias("ix")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    sums = {r["ix"]: r["n"] for r in ct.groupBy("ix").agg(F.sum("tf").alias("n")).collect()}
    all_docs = sum(docs.values()) + len(docs) * lam
    logden = {ix: math.log(sums.get(ix, 0.0) + n_terms * lam) for ix in docs if sums.get(ix, 0.0) + n_terms * lam > 0}
    classes = spark.createDataFrame(
        [(ix, n, math.log(n + lam) - math.log(all_docs), math.log(lam) - logden[ix]) for ix, n in docs.items()],
        "ix double, n_docs long, pi double, unseen_theta double")
    if not logden:
        return classes, ct.withColumn("theta", F.lit(None).cast("double"))
    known = F.create_map(*[F.lit(x) for pair in logden.items() for x in pair])
    return classes, ct.select("ix", "term", "tf", (F.ln(F.col("tf") + lam) - known[F.col("ix")]).alias("theta"))


def sparse_scores(test: DataFrame, classes: DataFrame, theta: DataFrame, features: str = "features",
                  id_col: str = "id") -> DataFrame:
    """``[id, prediction, scores]`` for every row of ``test`` from the tables
    of ``nb_parameters``, without a classes x vocabulary vector: ``scores``
    maps a class to its log score.

    A document's terms meet the observed (class, term) pairs, packed into one
    row per term; a pair adds ``count x (theta - unseen theta)``, and every
    known term adds its count to the total that the class's unseen theta is
    multiplied with.  Terms without a pair are not in the vocabulary and drop
    out.  Frequent terms are split over join partitions (``matching``).
    ``id_col`` identifies a row; ties go to the smaller class.  The classes
    are constants of the plan."""
    known = {r["ix"]: (r["pi"], r["unseen_theta"]) for r in classes.collect()}
    if not known:
        raise ValueError("no classes: the training data is empty")
    unseen = F.create_map(*[F.lit(x) for ix, (_, u) in known.items() for x in (ix, u)])
    delta = F.struct("ix", (F.col("theta") - unseen[F.col("ix")]).alias("x"))
    total = F.struct(F.lit(-1.0).alias("ix"), F.lit(1.0).alias("x"))  # adds up the known terms
    packed = theta.groupBy("term").agg(F.concat(F.array(total), F.collect_list(delta)).alias("parts"))
    # Every document has the term '', which is no one's.
    empty = theta.sparkSession.range(1).select(F.lit("").alias("term"), F.array(total).alias("parts"))
    terms = with_salt(document_terms(test, features, id_col))
    parts = terms.join(salted(packed.unionByName(empty)), ["term", "_salt"]).select("id", "cnt", F.explode("parts").alias("p"))
    sums = parts.groupBy("id", F.col("p.ix").alias("ix")).agg(F.sum(F.col("cnt") * F.col("p.x")).alias("x"))
    per_id = sums.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("ix", "x"))).alias("x"))

    def of(key: float):
        return F.coalesce(F.try_element_at("x", F.lit(key)), F.lit(0.0))

    scores = F.create_map(*[x for ix, (pi, u) in known.items() for x in (
        F.lit(ix), F.lit(pi) + of(ix) + of(-1.0) * F.lit(u))])
    best = F.array_max(F.transform(F.map_entries("scores"), lambda e: F.struct(e["value"], -e["key"])))
    return per_id.select("id", scores.alias("scores")).select(
        "id", (-best["col2"]).alias("prediction"), "scores")
