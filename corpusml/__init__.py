"""corpusml: document-corpus classification on Spark DataFrames.

Sub-packages
    sources    manifests, label files, document files, line numbering
    functions  tokenizers, n-grams, text views (column expressions)
    operators  vocabulary, vectors, idf, labels, naive Bayes, forest, scores
    plans      end-to-end jobs and the registered queries
    streaming  scoring of streaming DataFrames with fitted models
"""

from corpusml.operators.pipeline import FeaturePipeline
from corpusml.sources.corpus import load_corpus

__all__ = ["FeaturePipeline", "load_corpus"]
