"""Random forest on count vectors, with a pinned input layout.

A fixed seed alone does not make ``RandomForestClassifier`` reproducible:
bagging samples per partition, so another partition layout grows another
forest.  ``pinned_layout`` hash-partitions by document id and sorts inside
each partition, which fixes the layout for any input split; the number of
partitions follows from the number of rows, not from a session setting.

Every partition sends the statistics of every open node to every level's
shuffle, rows or none, so the shuffle is partitions x nodes: beyond
``FULL_PARTITIONS`` their number stays until each holds ``MOST_ROWS`` rows,
and grows in proportion to the rows from there on (nodes are bounded by trees
x 2^depth, so the shuffle never grows faster than the rows).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.session import scratch_dir

ROWS_PER_PARTITION = 1000
#: Partitions of ``ROWS_PER_PARTITION`` rows; more rows make them larger, up to ``MOST_ROWS``.
FULL_PARTITIONS, MOST_ROWS = 32, 50_000


def layout_partitions(n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    full = max(1, -(-n_rows // rows_per_partition))
    return max(min(full, FULL_PARTITIONS), -(-n_rows // MOST_ROWS))


def pinned_layout(df: DataFrame, num_partitions: int | None = None, key: str = "id") -> DataFrame:
    n = num_partitions or layout_partitions(df.select(key).count())
    return df.repartition(n, key).sortWithinPartitions(key)


def random_forest(features_col: str = "tokenCounts", label_col: str = "indexedLabel",
                  num_trees: int = 20, max_depth: int = 10, min_info_gain: float = 0.0,
                  seed: int = 12345, **kwargs) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=num_trees,
                                  maxDepth=max_depth, minInfoGain=min_info_gain, seed=seed, **kwargs)


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> DataFrame:
    """The fitted trees as a table ``[tree, node, feature, threshold, left,
    right, stats]`` (leaves have no feature): the model as Spark saves it,
    one row per node."""
    folder = f"{scratch_dir(spark, 'forest')}/model"
    model.write().save(folder)
    saved = spark.read.parquet(f"{folder}/data")
    cut = F.col("nodeData.split")
    leaf = F.col("nodeData.leftChild") < 0
    return saved.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(~leaf, cut["featureIndex"]).alias("feature"),
        F.when(~leaf, cut["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.impurityStats").alias("stats"))


def forest_votes(df: DataFrame, nodes: DataFrame, features_col: str = "tokenCounts", id_col: str = "id") -> DataFrame:
    """``[id, prediction, votes]``: every row walks all trees at once, one
    level per join with the node table, and adds up the class shares of the
    leaves.  Rows carry their sparse entries as a map; ``id_col`` identifies
    a row; ties go to the smaller class.  The node table is a model parameter
    (trees x 2^depth rows at most); joins end with the deepest path."""
    own = F.unwrap_udt(features_col)
    entries = df.select(F.col(id_col).alias("id"), F.when(own["type"] == 0, F.map_from_arrays(own["indices"], own["values"]))
                        .otherwise(F.map_from_entries(F.transform(own["values"], lambda v, i: F.struct(i, v)))).alias("x"))
    trees = nodes.select("tree").distinct()
    roots = F.array(*[F.lit(r["tree"]) for r in trees.collect()])  # one entry per tree
    at = entries.withColumn("tree", F.explode(roots)).withColumn("node", F.lit(0))
    value = F.coalesce(F.try_element_at("x", F.col("feature")), F.lit(0.0))
    step = F.when(F.col("feature").isNull(), F.col("node")).when(value <= F.col("threshold"), F.col("left")).otherwise(
        F.col("right"))
    for _ in range(_depth(nodes)):
        at = at.join(nodes.drop("stats"), ["tree", "node"]).select("id", "x", "tree", step.alias("node"))
    share = F.transform("stats", lambda s: s / F.aggregate("stats", F.lit(0.0), lambda a, b: a + b))
    votes = at.join(nodes.select("tree", "node", "stats"), ["tree", "node"]).select("id", F.posexplode(share).alias("ix", "v"))
    summed = votes.groupBy("id", "ix").agg(F.sum("v").alias("v")).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("ix", "v"))).alias("v"))
    votes = F.transform("v", lambda e: e["v"])
    return summed.select("id", (F.array_position(votes, F.array_max(votes)) - 1).cast("double").alias("prediction"),
                         votes.alias("votes"))


def _depth(nodes: DataFrame) -> int:
    """Edges of the longest path, level by level over the node table."""
    level, depth = nodes.where("node = 0"), 0
    while True:
        inner = level.where("feature IS NOT NULL")
        below = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
        if below.isEmpty():
            return depth
        level, depth = nodes.join(below, ["tree", "node"], "left_semi"), depth + 1
