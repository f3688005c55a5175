"""Exact top-k inner-product search with MaxScore.

Vectors become integers; every dimension is a query term whose postings are
the rows with a non-zero weight there.  Rows are dealt to shards and queries
to blocks; each (shard, block) is one group:

* per term, ``query weight x largest / smallest posted weight`` bounds what
  it can add to a score;
* terms are ordered by how far their bounds lie apart; those whose joint
  upper bounds cannot lift a row over the current k-th score are
  non-essential;
* the essential postings are traversed block by block; rows that could
  still be competitive are probed in the non-essential terms, largest
  first, and dropped as soon as the remaining bounds cannot save them.

The shards' best rows are merged by a window over each query.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; missing dimensions count as 0; rows with the same vector id
are separate rows (only the query's own row is no candidate), ties go to
the smaller vector id; an empty table gives no rows.  Queries whose sums
could leave a long are scored with Python's integers; a quantised component
beyond +-2**62, or a score among a shard's best that no long holds, fails the
job (scores are longs, as in the SQL).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusml.llm.common import materialize

K = 5
SHARD_ROWS, QUERY_BLOCK, TRAVERSED = 4096, 256, 1024
LARGEST = 1 << 62
#: Sums up to this are taken in longs (a bound plus a score stays below 2**63).
LONG_SUM = 1 << 60


def quantised(col: str, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component, ``x`` as double."""
    def component(x: Column) -> Column:
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) <= float(LARGEST), F.floor(y)).otherwise(F.raise_error("vector component out of range"))

    return F.transform(col, component)


def usable(col: str) -> Column:
    """Not null, and no component null, NaN or infinite."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(col).isNotNull() & ~bad


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((dims, len(vectors)), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[:len(v), k] = v
    return out


def maxscore(postings: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int,
             own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, scores)`` of the k best columns of ``postings`` (terms x
    rows), ties to smaller ids; column ``own`` is no candidate."""
    ends = np.stack([query * postings.max(axis=1), query * postings.min(axis=1)])
    upper, lower = ends.max(axis=0), ends.min(axis=0)
    order = np.argsort(lower - upper, kind="stable")  # widest bounds first
    upper = upper[order]
    rest = np.concatenate([np.cumsum(upper[::-1])[::-1], [0]])  # rest[t]: bound of terms t, t+1, ...
    floor = np.concatenate([[0], np.cumsum(lower[order])])  # floor[t]: least sum of terms before t
    weights = query[order]
    best_ids, best = np.zeros(0, dtype=ids.dtype), np.zeros(0, dtype=np.int64)
    for start in range(0, postings.shape[1], TRAVERSED):
        block = postings[:, start:start + TRAVERSED]
        rows = np.arange(block.shape[1])
        if own is not None and start <= own < start + TRAVERSED:
            rows = np.delete(rows, own - start)
        full = len(best) == k
        # Essential: the fewest terms without which no row reaches the k-th score.
        need = int(np.argmax(floor + rest < best[-1])) if full and (floor + rest < best[-1]).any() else len(weights)
        need = max(need, 1) if full else len(weights)
        score = weights[:need] @ block[order[:need]]
        score = score[rows]
        for t in range(need, len(weights) + 1):
            if full:
                alive = score + rest[t] >= best[-1]
                rows, score = rows[alive], score[alive]
            if t == len(weights) or not len(rows):
                break
            score = score + weights[t] * block[order[t], rows]
        if len(rows):
            all_ids = np.concatenate([best_ids, ids[start + rows]])
            all_scores = np.concatenate([best, score])
            top = np.lexsort((all_ids, -all_scores))[:k]
            best_ids, best = all_ids[top], all_scores[top]
    return best_ids, best


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
           k: int = K, scale: int = 256) -> DataFrame:
    """``[query_id, rank, id_col, score]``: the k rows with the highest
    integer inner product for every row of ``vectors`` with ``is_query``."""
    rows = materialize(
        vectors.where(usable(vector_col)).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"), quantised(vector_col, scale).alias("v")), "vectors")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // QUERY_BLOCK))
    dealt = F.xxhash64("row")
    # The stated query set meets all rows in groups of one shard and one block.
    posted = rows.select("row", "id", "v", F.pmod(dealt, F.lit(shards)).alias("shard"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = rows.where("is_query").select("row", "id", "v", F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"),
                                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def best(group: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(group) and len(queries):
            dims = max(1, max(map(len, group["v"])), max(map(len, queries["v"])))
            group = group.sort_values("row")  # the same traversal whatever the shuffle's order
            postings, ids, own = _matrix(group["v"], dims), group["id"].to_numpy(), group["row"].to_numpy()
            terms = _matrix(queries["v"], dims)
            most = np.abs(postings).max(axis=1).astype(np.float64) @ np.abs(terms).astype(np.float64)
            wide = postings.astype(object) if (most > LONG_SUM).any() else None
            for q, (row, query_id) in enumerate(zip(queries["row"], queries["id"], strict=True)):
                at = int(np.searchsorted(own, row))
                here = at if at < len(own) and own[at] == row else None
                if most[q] > LONG_SUM:
                    top, scores = maxscore(wide, ids, terms[:, q].astype(object), k, here)
                    if not all(-1 << 63 <= s < 1 << 63 for s in scores):
                        raise OverflowError("score out of range of a long")
                else:
                    top, scores = maxscore(postings, ids, terms[:, q], k, here)
                found += [(row, query_id, i, s) for i, s in zip(top, scores, strict=True)]
        return pd.DataFrame(found, columns=["query_row", "query_id", "id", "score"])

    id_type = rows.schema["id"].dataType.simpleString()
    merged = posted.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        best, f"query_row long, query_id {id_type}, id {id_type}, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")


#: The same rows in DuckDB SQL (k = 5, scale = 256, ids divisible by 50).
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
