"""Vocabulary, term counts and count vectors.

All statistics are aggregations over exploded token lists.  Per document the
token list lives in one row, so ``array_distinct`` gives document frequency
without a (document, term) shuffle: a single explode of
``tokens ++ distinct(tokens)`` feeds one ``groupBy(term)`` whose map-side
partial aggregation collapses every hot term to one row per partition before
the shuffle.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.functions.tokens import explode_tokens
from corpusml.operators.matching import salted, with_salt
from corpusml.operators.ranking import global_rank

DEFAULT_VOCAB_SIZE = 1 << 18


def term_stats(df: DataFrame, features: str = "features") -> DataFrame:
    """``[term string, tf bigint, df bigint]``: corpus count and number of
    rows (documents) containing the term.

    One pass: ``posexplode(tokens ++ array_distinct(tokens))``; a position
    past the token count marks a row of the distinct half, which counts
    towards ``df``.  No per-token struct is built.
    """
    toks = F.col(features)
    both = df.select(F.size(toks).alias("_n"),
                     F.posexplode_outer(F.concat(toks, F.array_distinct(toks))).alias("_pos", "term"))
    return (both.where(F.col("term").isNotNull())
            .groupBy("term").agg(F.count(F.when(F.col("_pos") < F.col("_n"), True)).alias("tf"),
                                 F.count(F.when(F.col("_pos") >= F.col("_n"), True)).alias("df")))


def _threshold(value: float | None, n_docs_fn) -> float | None:
    if value is None:
        return None
    return float(value) if value >= 1.0 else float(value) * n_docs_fn()


def filtered_stats(df: DataFrame, features: str = "features", min_df: float = 1.0,
                   max_df: float | None = None) -> DataFrame:
    """``term_stats`` with document-frequency bounds: absolute counts when
    >= 1, fractions of the number of rows otherwise.  Every term that
    passes is kept; nothing is capped."""
    stats = term_stats(df, features)
    n_docs = _memo(lambda: df.count())
    lo, hi = _threshold(min_df, n_docs), _threshold(max_df, n_docs)
    if lo is not None and lo > 1:
        stats = stats.where(F.col("df") >= lo)
    return stats if hi is None else stats.where(F.col("df") <= hi)


def build_vocabulary(df: DataFrame, features: str = "features", min_df: float = 1.0,
                     max_df: float | None = None, vocab_size: int = DEFAULT_VOCAB_SIZE) -> DataFrame:
    """``[ix int, term, tf, df]`` ordered by ``(tf desc, term asc)``: the at
    most ``vocab_size`` terms of a count-vector model.

    The candidates (one row per term) are ranked by ``global_rank`` whatever
    their number.  The result is a model parameter of bounded size, held by
    the driver: nothing stays cached or checkpointed."""
    stats = filtered_stats(df, features, min_df, max_df)
    with global_rank(stats, [F.col("tf").desc(), F.col("term").asc()], "ix", limit=vocab_size) as ranked:
        rows = ranked.select(F.col("ix").cast("int").alias("ix"), "term", "tf", "df").collect()
    return df.sparkSession.createDataFrame(sorted(rows), "ix int, term string, tf long, df long")


def _memo(fn):
    box = []

    def get():
        if not box:
            box.append(fn())
        return box[0]
    return get


def vocabulary_terms(vocabulary: DataFrame) -> list[str]:
    """Terms in index order (bounded by ``vocab_size``: model parameters)."""
    return [r["term"] for r in vocabulary.orderBy("ix").select("term").collect()]


def term_counts(df: DataFrame, vocabulary: DataFrame | None = None, features: str = "features",
                id_col: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Long form of token lists: ``[id, *keep, term, cnt bigint]``, grouped
    by (id, term); out-of-vocabulary tokens are dropped.  The vocabulary is a
    table of any size that the counts meet (frequent terms are split over
    join partitions); up to ``vocab_size``, ``vector_counts`` gives the same
    from count vectors without a shuffle."""
    e = explode_tokens(df, features, "term", keep=(id_col, *keep))
    counts = e.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("cnt"))
    if vocabulary is None:
        return counts
    known = with_salt(counts, id_col).join(salted(vocabulary.select("term")), ["term", "_salt"], "left_semi")
    return known.select(counts.columns)


def vector_counts(df: DataFrame, terms: list[str], vector_col: str, id_col: str = "id",
                  value_col: str = "cnt", as_type: str = "bigint") -> DataFrame:
    """``[id, term, value]``: one row per stored entry of a sparse vector
    column, ``terms`` naming the dimensions (the model's vocabulary).
    Row by row: no shuffle and no join."""
    named = F.array(*[F.lit(t) for t in terms])
    entries = df.select(id_col, F.unwrap_udt(vector_col).alias("_v")).select(
        id_col, F.explode(F.arrays_zip("_v.indices", "_v.values")).alias("_e"))
    return entries.select(id_col, F.element_at(named, F.col("_e.indices") + 1).alias("term"),
                          F.col("_e.values").cast(as_type).alias(value_col))


class OrderedCountVectorizer(Estimator, HasInputCol, HasOutputCol):
    """Count-vector estimator with a deterministic vocabulary order.

    Same parameters and model as ``pyspark.ml.feature.CountVectorizer``
    (``minDF``, ``maxDF``, ``vocabSize``, ``minTF``, ``binary``), but terms
    are ranked by ``(corpus count desc, term asc)``, so equal counts never
    reorder the vector layout between runs.  ``fit`` returns a plain
    ``CountVectorizerModel``.
    """

    minDF = Param(Params._dummy(), "minDF", "minimum document frequency (count or fraction)",
                  typeConverter=TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "maximum document frequency (count or fraction)",
                  typeConverter=TypeConverters.toFloat)
    vocabSize = Param(Params._dummy(), "vocabSize", "maximum vocabulary size",
                      typeConverter=TypeConverters.toInt)
    minTF = Param(Params._dummy(), "minTF", "minimum term frequency in a document",
                  typeConverter=TypeConverters.toFloat)
    binary = Param(Params._dummy(), "binary", "binary counts", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="counts", minDF=1.0, maxDF=None,
                 vocabSize=DEFAULT_VOCAB_SIZE, minTF=1.0, binary=False):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="counts", minDF=1.0,
                         vocabSize=DEFAULT_VOCAB_SIZE, minTF=1.0, binary=False)
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCol=None, outputCol=None, minDF=None, maxDF=None, vocabSize=None,
                  minTF=None, binary=None):
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        return self._set(**kwargs)

    def setInputCol(self, value):
        return self._set(inputCol=value)

    def setOutputCol(self, value):
        return self._set(outputCol=value)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        max_df = self.getOrDefault(self.maxDF) if self.isDefined(self.maxDF) else None
        vocab = build_vocabulary(dataset, self.getInputCol(), self.getOrDefault(self.minDF),
                                 max_df, self.getOrDefault(self.vocabSize))
        terms = vocabulary_terms(vocab)
        if not terms:
            raise ValueError("empty vocabulary: minDF/maxDF leave no term in the training data")
        return CountVectorizerModel.from_vocabulary(
            terms, inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
            minTF=self.getOrDefault(self.minTF), binary=self.getOrDefault(self.binary))
