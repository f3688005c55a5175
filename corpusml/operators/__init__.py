"""Operators: vocabulary, vectors, weighting, labels, models, evaluation."""

from corpusml.operators.bayes import naive_bayes, nb_parameters
from corpusml.operators.evaluate import (
    accuracy, correct, predictions, preview, write_predictions,
)
from corpusml.operators.forest import layout_partitions, pinned_layout, random_forest
from corpusml.operators.labels import (
    index_labels, label_decoder, label_dictionary, label_indexer,
)
from corpusml.operators.pipeline import FeaturePipeline
from corpusml.operators.restrict import likely_listed, restrict
from corpusml.operators.vocabulary import (
    DEFAULT_VOCAB_SIZE, OrderedCountVectorizer, build_vocabulary, filtered_stats, term_counts, term_stats,
    vector_counts, vocabulary_terms,
)
from corpusml.operators.weighting import idf_weights, tfidf

__all__ = [
    "DEFAULT_VOCAB_SIZE", "FeaturePipeline", "OrderedCountVectorizer", "accuracy", "build_vocabulary",
    "correct", "filtered_stats", "idf_weights", "index_labels", "label_decoder", "label_dictionary",
    "label_indexer", "layout_partitions", "likely_listed", "naive_bayes", "nb_parameters", "pinned_layout", "predictions",
    "preview", "random_forest", "restrict", "term_counts", "term_stats", "tfidf", "vector_counts", "vocabulary_terms",
    "write_predictions",
]
