"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import discard, materialize


def _symmetric(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(links: DataFrame, name: str) -> DataFrame:
    """Large-star then small-star: every node's larger neighbours, then its
    smaller ones, are linked to the least node that it sees.  ``links`` is
    discarded."""
    around = _symmetric(links)
    lowest = materialize(around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")),
                         f"{name}_lowest")
    large = materialize(around.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u <> v").distinct(), f"{name}_large")
    # Every link now points from the larger to the smaller node.
    least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}_least")
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    stars = materialize(small.where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
    discard(links, lowest, large, least)
    return stars


def component_roots(links: DataFrame) -> DataFrame:
    """``[node, root]`` for every node of ``links [u, v]`` (``u <> v``): the
    root is the least node reachable.  The loop ends when a round changes
    nothing (the links are then stars around the roots); rounds grow with
    the logarithm of the longest path.  Only counts reach the driver."""
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    current, step = materialize(links.select("u", "v").distinct(), "links"), 0
    before = state(current)
    while before[0]:
        current = _star(current, f"star_{step}")
        after, step = state(current), step + 1
        if after == before:
            break
        before = after
    members = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)
