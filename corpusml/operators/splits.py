"""Split statistics of a decision tree as tables.

What a tree learner gathers at a node, for every feature at once: how many
rows of each class have which value, prefix sums along the values, and the
impurity of both sides of every candidate threshold.  Rows that lack a
feature have the value 0 and are never made: their numbers are the class
totals minus the rows seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BINS = 32
#: Digits to which gains are compared: equal gains of two thresholds stay equal in any order of sums.
GAIN_DIGITS = 9


def _gini(counts: list[Column], rows: Column) -> Column:
    # Squares in doubles: class totals are literals of 32 bits, whose product overflows from 46,341 rows on.
    counts, rows = [c.cast("double") for c in counts], rows.cast("double")
    parts = counts[0] * counts[0]
    for c in counts[1:]:
        parts = parts + c * c
    return F.when(rows > 0, 1.0 - parts / (rows * rows)).otherwise(0.0)


def root_splits(counts: DataFrame, labels: DataFrame, value_col: str = "cnt", max_bins: int = MAX_BINS) -> DataFrame:
    """``[term, threshold, n_left, gain]``: the best split ``value <=
    threshold`` of every feature in ``counts [id, term, value]`` for the
    classes of ``labels [id, ix]`` (one row per document).

    Values are binned by their rank among all documents (``max_bins`` bins
    of about equal size); candidate thresholds are the largest values of the
    bins.  Equal gains go to the smaller threshold; a feature with one value
    everywhere has no split.  One row per (feature, value) meets in a window;
    the class totals are constants of the plan."""
    totals = {r["ix"]: r["n"] for r in labels.groupBy("ix").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes, n = sorted(totals), sum(totals.values())
    names = [f"_n{k}" for k in range(len(classes))]
    seen = counts.join(labels, "id").groupBy("term", F.col(value_col).cast("double").alias("value")).agg(
        *[F.count(F.when(F.col("ix") == c, True)).alias(x) for c, x in zip(classes, names, strict=True)])
    absent = seen.groupBy("term").agg(F.lit(0.0).alias("value"), *[
        (F.lit(totals[c]) - F.sum(x)).alias(x) for c, x in zip(classes, names, strict=True)])
    rows = sum((F.col(x) for x in names), F.lit(0))
    histogram = seen.unionByName(absent).where(rows > 0).groupBy("term", "value").agg(
        *[F.sum(x).alias(x) for x in names])
    by = Window.partitionBy("term").orderBy("value")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    left = histogram.select("term", "value", *[F.sum(x).over(upto).alias(x) for x in names]).withColumn("n_left", rows)
    binned = left.withColumn("bin", F.floor((F.col("n_left") - 1) * max_bins / n))
    # The last value of a bin, unless no value follows.
    cuts = binned.withColumn("next", F.lead("bin").over(by)).where("next > bin")
    l_counts = [F.col(x) for x in names]
    r_counts = [F.lit(totals[c]) - x for c, x in zip(classes, l_counts, strict=True)]
    n_left, n_right = F.col("n_left"), F.lit(n) - F.col("n_left")
    gain = (_gini([F.lit(totals[c]) for c in classes], F.lit(n)) - n_left / n * _gini(l_counts, n_left)
            - n_right / n * _gini(r_counts, n_right))
    best = F.max(F.struct(F.round(gain, GAIN_DIGITS).alias("gain"), (-F.col("value")).alias("t"), "n_left")).alias("b")
    return cuts.groupBy("term").agg(best).select(
        "term", (-F.col("b.t")).alias("threshold"), F.col("b.n_left").alias("n_left"), F.col("b.gain").alias("gain"))
