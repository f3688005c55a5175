"""Scores and outputs as DataFrames (nothing is printed or looped on the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correct(label_col: str = "label", prediction_col: str = "predictedClass"):
    """1.0 when label equals prediction (compared as strings), else 0.0."""
    return (F.col(label_col).cast("string") == F.col(prediction_col).cast("string")).cast("double")


def accuracy(df: DataFrame, label_col: str = "label", prediction_col: str = "predictedClass",
             weight_col: str | None = None) -> DataFrame:
    """One row ``[accuracy double]``.  With ``label_col='indexedLabel'`` and
    ``prediction_col='prediction'`` it is the multiclass evaluator's
    accuracy (weighted when ``weight_col`` is given)."""
    c = correct(label_col, prediction_col)
    if weight_col is None:
        return df.agg(F.avg(c).alias("accuracy"))
    w = F.col(weight_col).cast("double")
    return df.agg((F.sum(c * w) / F.sum(w)).alias("accuracy"))


def predictions(df: DataFrame, id_col: str = "id", class_col: str = "predictedClass",
                cast: str | None = None) -> DataFrame:
    """``[id, predictedClass]`` ordered by id (``cast='int'`` for numeric labels)."""
    cls = F.col(class_col).cast(cast) if cast else F.col(class_col)
    return df.select(id_col, cls.alias(class_col)).orderBy(id_col)


def write_predictions(df: DataFrame, path: str, id_col: str = "id",
                      class_col: str = "predictedClass", mode: str = "error") -> None:
    """Write one predicted class per line, in id order, as text files.

    ``orderBy`` range-partitions the rows, so part files hold consecutive id
    ranges: reading them in name order gives the whole ordered list.  Every
    task writes its own range; nothing passes through the driver."""
    (df.orderBy(id_col).select(F.col(class_col).cast("string").alias("value"))
     .write.mode(mode).text(path))


def preview(df: DataFrame, n: int = 20, id_col: str = "id") -> DataFrame:
    """The first ``n`` rows by id (a top-k: each partition keeps n rows)."""
    return df.orderBy(id_col).limit(n)
