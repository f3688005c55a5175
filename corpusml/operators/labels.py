"""Label dictionary: string label <-> dense double index.

Order: frequency descending, ties by the label *string* ascending (labels
are compared as strings, so bigint 10 sorts before 2).  Rows whose label is
null or absent from the dictionary are removed (``handleInvalid='skip'``).
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_indexer(label_col: str = "label", output_col: str = "indexedLabel") -> StringIndexer:
    return StringIndexer(inputCol=label_col, outputCol=output_col, handleInvalid="skip",
                         stringOrderType="frequencyDesc")


def label_decoder(labels: list[str], input_col: str = "prediction",
                  output_col: str = "predictedClass") -> IndexToString:
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=labels)


def label_dictionary(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``[label string, n bigint, ix double]`` (one row per class)."""
    counts = (df.where(F.col(label_col).isNotNull())
              .groupBy(F.col(label_col).cast("string").alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    # One row per class: the global ordering window is over a tiny table.
    order = Window.orderBy(F.col("n").desc(), F.col("label").asc())
    return counts.select("label", "n", (F.row_number().over(order) - 1).cast("double").alias("ix"))


def index_labels(df: DataFrame, dictionary: DataFrame, label_col: str = "label",
                 output_col: str = "indexedLabel") -> DataFrame:
    """``StringIndexer(handleInvalid='skip')`` with a given dictionary.

    The dictionary becomes the model's label list (one entry per class), so
    rows are indexed where they are: a label is a hot key that is never
    joined or shuffled."""
    labels = [r["label"] for r in dictionary.orderBy("ix").select("label").collect()]
    if not labels:
        return df.where(F.lit(False)).withColumn(output_col, F.lit(None).cast("double"))
    return StringIndexerModel.from_labels(labels, inputCol=label_col, outputCol=output_col,
                                          handleInvalid="skip").transform(df)
