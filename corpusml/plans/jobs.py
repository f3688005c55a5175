"""The two classification jobs, as functions that return DataFrames.

``fit_naive_bayes`` / ``fit_random_forest`` train on a labelled token table
``[id, features, label]`` and return a ``FittedClassifier`` whose ``score``
is a lazy DataFrame plan.  ``nb_job`` / ``rf_job`` add the file sources:
manifest + labels + document files in, predictions or accuracy out.

Driver crossings are limited to fitted parameters: the label list (one entry
per class), the vocabulary (at most ``vocab_size`` terms) and the model
coefficients (classes x vocabulary, or the trees).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.feature import IDF, NGram, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession

from corpusml.operators.bayes import naive_bayes
from corpusml.operators.evaluate import accuracy, predictions
from corpusml.operators.forest import layout_partitions, pinned_layout, random_forest
from corpusml.operators.labels import label_decoder, label_indexer
from corpusml.operators.pipeline import FeaturePipeline
from corpusml.operators.vocabulary import DEFAULT_VOCAB_SIZE, OrderedCountVectorizer
from corpusml.sources.corpus import labelled_manifest, load_corpus


@dataclass
class FittedClassifier:
    indexer: StringIndexerModel
    features: FeaturePipeline | _CountsAs
    model: Model
    label_col: str = "label"
    extra: dict = field(default_factory=dict)

    @property
    def labels(self) -> list[str]:
        return list(self.indexer.labels)

    def score(self, test: DataFrame, labelled: bool | None = None) -> DataFrame:
        """Predictions for ``test``: adds ``rawPrediction, probability,
        prediction, predictedClass`` (and ``indexedLabel`` when labelled;
        rows with an unseen or null label are then removed)."""
        if labelled is None:
            labelled = self.label_col in test.columns
        if labelled:
            test = self.indexer.transform(test)
        scored = self.model.transform(self.features.transform(test))
        return label_decoder(self.labels).transform(scored)


def _persist(df: DataFrame, cache: bool) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK) if cache else df


def fit_naive_bayes(train: DataFrame, *, idf: bool = False, ngram: int = 1, min_df: float = 1.0,
                    vocab_size: int = DEFAULT_VOCAB_SIZE, smoothing: float = 1.0, label_col: str = "label",
                    cache: bool = False, labels: DataFrame | None = None) -> FittedClassifier:
    """Label index -> n-gram -> counts (-> idf) -> multinomial NB.

    ``labels``: the training labels as a table of their own (a labelled
    manifest), so that indexing them opens no document.

    ``cache`` persists the labelled token table for the fits (one
    tokenization instead of two); off by default: the token lists are as
    large as the texts, and re-running the JVM tokenizer was measured
    cheaper than building and reading that cache."""
    indexer = label_indexer(label_col).fit(train.select(label_col) if labels is None else labels)
    prep = FeaturePipeline()
    if int(ngram) != 1:  # NGram(n=1) is the identity
        prep.add(NGram(n=int(ngram)))
    prep.add(OrderedCountVectorizer(minDF=min_df, vocabSize=vocab_size))
    if idf:
        prep.add(IDF())
    tokens = _persist(indexer.transform(train), cache)
    try:
        vectors = prep.fit(tokens, cache_vectors=True)
        model = naive_bayes(smoothing=smoothing).fit(vectors)
    finally:
        prep.release()
        if cache:
            tokens.unpersist()
    return FittedClassifier(indexer, prep, model, label_col)


def fit_random_forest(train: DataFrame, *, min_df: float = 10.0, vocab_size: int = DEFAULT_VOCAB_SIZE,
                      num_trees: int = 20, max_depth: int = 10, min_info_gain: float = 0.0,
                      seed: int = 12345, num_partitions: int | None = None, label_col: str = "label",
                      id_col: str = "id", cache: bool = True, labels: DataFrame | None = None) -> FittedClassifier:
    """Counts (minDF 10, no n-gram, no idf) -> label index -> random forest.

    The training rows are laid out by ``pinned_layout`` first, so the same
    data gives the same forest whatever the input split; the number of
    partitions is kept in ``extra["layout_partitions"]``.  ``labels``: the
    training labels ``[id, label]`` as a table of their own, which is then
    read for the label index and the row count instead of the documents."""
    prep = FeaturePipeline().add(OrderedCountVectorizer(minDF=min_df, vocabSize=vocab_size))
    counts = prep.fit(train).withColumnRenamed("features", "tokenCounts")
    thin = train.select(id_col, label_col) if labels is None else labels
    indexer = label_indexer(label_col).fit(thin)
    num_partitions = num_partitions or layout_partitions(indexer.transform(thin).count())
    # The forest reads its input several times (metadata, split candidates,
    # binned points): keep the laid-out count vectors, not the token lists.
    laid_out = _persist(pinned_layout(indexer.transform(counts).select(id_col, "tokenCounts", "indexedLabel"),
                                      num_partitions, id_col), cache)
    try:
        model = random_forest("tokenCounts", "indexedLabel", num_trees, max_depth, min_info_gain,
                              seed).fit(laid_out)
    finally:
        if cache:
            laid_out.unpersist()
    return FittedClassifier(indexer, _CountsAs(prep, "tokenCounts"), model, label_col,
                            {"layout_partitions": num_partitions})


@dataclass
class _CountsAs:
    """Applies a fitted pipeline and names its output ``column``."""

    pipeline: FeaturePipeline
    column: str

    def transform(self, x: DataFrame) -> DataFrame:
        return self.pipeline.transform(x).withColumnRenamed("features", self.column)


def _finish(spark: SparkSession, scored: DataFrame, labelled: bool, label_col: str,
            prediction_col: str, id_col: str = "id") -> DataFrame:
    if labelled:
        return accuracy(scored, label_col, prediction_col)
    return predictions(scored, id_col, "predictedClass", cast="int")


def nb_job(spark: SparkSession, train_x, train_y, test_x, test_y=None, *, idf: bool = False,
           ngram: int = 1, base="./data", kind: str = "bytes", lowercase: bool = False,
           vocabulary=None, aliases=None, min_df: float = 1.0, vocab_size: int = DEFAULT_VOCAB_SIZE,
           cache: bool = False, table: str | None = None) -> DataFrame:
    """Naive Bayes job.  Accuracy ``[accuracy]`` when ``test_y`` is given,
    else ``[id, predictedClass int]`` ordered by id.  ``table``: an ingested
    corpus (``ingest_documents``)."""
    train = load_corpus(spark, train_x, train_y, base, kind, vocabulary, lowercase, aliases, table)
    test = load_corpus(spark, test_x, test_y, base, kind, vocabulary, lowercase, aliases, table)
    fitted = fit_naive_bayes(train, idf=idf, ngram=ngram, min_df=min_df, vocab_size=vocab_size, cache=cache,
                             labels=labelled_manifest(spark, train_x, train_y))
    scored = fitted.score(test, labelled=test_y is not None)
    return _finish(spark, scored, test_y is not None, "label", "predictedClass")


def rf_job(spark: SparkSession, train_x, train_y, test_x, test_y=None, *, base="./data",
           lowercase: bool = False, vocabulary=None, aliases=None, min_df: float = 10.0,
           num_partitions: int | None = None, vocab_size: int = DEFAULT_VOCAB_SIZE,
           table: str | None = None) -> DataFrame:
    """Random forest job on joint token counts.  Accuracy (evaluator form:
    ``prediction`` vs ``indexedLabel``) when ``test_y`` is given, else
    ``[id, predictedClass int]`` ordered by id."""
    bags = {"base": base, "kind": "joint", "vocabulary": vocabulary, "lowercase": lowercase, "aliases": aliases,
            "table": table, "ordered": False}
    train = load_corpus(spark, train_x, train_y, **bags)
    test = load_corpus(spark, test_x, test_y, **bags)
    fitted = fit_random_forest(train, min_df=min_df, num_partitions=num_partitions, vocab_size=vocab_size,
                               labels=labelled_manifest(spark, train_x, train_y))
    scored = fitted.score(test, labelled=test_y is not None)
    return _finish(spark, scored, test_y is not None, "indexedLabel", "prediction")
