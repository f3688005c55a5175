"""Ranked lexical search with range-maximum sparse tables.

Every query's best documents under an integer form of BM25:

1. one pass over the documents counts the terms of each; only postings of
   terms that some query has are kept (one more row per document carries its
   length, so that the corpus statistics cover all documents);
2. a posting's impact depends on its document alone, a query's weight of a
   term on the term alone: a score is the sum of weight x impact;
3. documents are dealt to shards of about ``SHARD_POSTINGS`` postings.  In a
   shard the posting lists, ordered by document, lie one behind the other
   below one sparse table of range maxima (a range inside a list only ever
   reads windows inside that list);
4. a query starts with one interval, the whole shard.  The sum of weight x
   range maximum over its terms bounds every score in an interval.  The
   intervals with the largest bounds are split at the document of their
   largest term contribution, which is scored exactly; both sides get their
   own bounds, and intervals that cannot reach the current k-th score are
   dropped.  Ties are kept until the bound is beaten;
5. the shards' best are merged by a window over each query.

Queries travel to every shard in blocks of ``QUERY_BLOCK``; postings are
shuffled once for each block.  A shard's size is bounded by its postings: a
document has at most one for every term that some query holds.

Defined cases: null texts have no terms and are never found; a query without
known terms gets no rows; repeated document rows are separate documents,
repeated query rows separate queries (with equal ids both appear); documents
without an id come last in ties; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusml.llm.common import bounded, discard, materialize

K = 10
SHARD_POSTINGS, QUERY_BLOCK = 400_000, 4096
#: Most intervals that are split at a time, best first.
WAVE = 192
# Of the bytes of a term, A-Z are lower-cased; all but ASCII
# letters, digits and bytes beyond ASCII separate terms.
TERM_BYTES = bytes(b | 0x20 if chr(b).isascii() and chr(b).isalpha() else
                   b if b > 0x7F or chr(b).isdigit() else 0x20 for b in range(256))
#: Postings of a task that are sent on at a time.
SENT = 200_000
POSTINGS = "row long, doc_id long, n long, term string, tf long"


def terms_of(text: str | None) -> Counter:
    """The terms of a text and their numbers."""
    found = Counter((text or "").encode().translate(TERM_BYTES).decode().split(" "))
    del found[""]
    return found


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``POSTINGS`` rows: the terms of every document, and one row with the
    term '' for the document itself."""
    names = ["row", "doc_id", "n", "term", "tf"]

    def table(rows, ids, ns, counts, terms, tfs):
        wide = [np.repeat(np.array(x, dtype=np.int64), counts) for x in (rows, ns)]
        at = np.repeat(np.arange(len(ids)), counts)
        return pa.RecordBatch.from_arrays([
            pa.array(wide[0]), pa.array(ids, pa.int64()).take(pa.array(at)), pa.array(wide[1]),
            pa.array(terms, pa.string()), pa.array(tfs, pa.int64())], names=names)

    for batch in batches:
        held = [[], [], [], [], [], []]
        for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counted = terms_of(text)
            own = (row, doc_id, counted.total(), len(counted) + 1)
            for column, value in zip(held, own, strict=False):
                column.append(value)
            held[4] += ["", *counted]
            held[5] += [0, *counted.values()]
            if len(held[4]) >= SENT:
                yield table(*held)
                held = [[], [], [], [], [], []]
        if held[0]:
            yield table(*held)


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``[query, id, term, times]``: the terms of every query row."""
    rows = queries.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text_col))
    cut = rows.mapInArrow(_postings, POSTINGS)
    return cut.where("tf > 0").select(F.col("row").alias("query"), F.col("doc_id").alias("id"), "term",
                                      F.col("tf").alias("times"))


class Shard:
    """Posting lists (by term, then document) with their range maxima."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        order = np.lexsort((docs, terms))
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.docs, self.impacts, self.n_docs = docs[order], impacts[order], n_docs
        lists = np.repeat(np.arange(len(self.terms), dtype=np.int64), np.diff(self.starts))
        self.keys = lists * n_docs + self.docs
        # best[j][i]: place of the largest impact in places i .. i + 2**j - 1
        self.best = [np.arange(len(order), dtype=np.int32)]
        longest, step = int(np.diff(self.starts).max(initial=0)), 1
        while step * 2 <= longest:
            left, right = self.best[-1][:-step], self.best[-1][step:]
            self.best.append(np.where(self.impacts[left] >= self.impacts[right], left, right))
            step *= 2
        self.table = np.zeros((len(self.best), len(order)), dtype=np.int32)
        for j, row in enumerate(self.best):
            self.table[j, :len(row)] = row
        self.best = None

    def range_best(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest impact in ``a .. b - 1`` (0 if empty)."""
        length = np.maximum(b - a, 1)
        level = np.frexp(length.astype(np.float64))[1] - 1
        first = np.minimum(a, self.table.shape[1] - 1)
        left = self.table[level, first]
        right = self.table[level, np.maximum(b - (1 << level), first)]
        return np.where(self.impacts[left] >= self.impacts[right], left, right)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """``[(score, document)]``: the ``k`` best with a score above 0,
        equal scores by document."""
        known = np.searchsorted(self.terms, terms)
        found = (known < len(self.terms)) & (weights > 0)
        found[found] = self.terms[known[found]] == terms[found]
        lists, weights = known[found], weights[found]
        if not len(lists):
            return []
        base = lists.astype(np.int64) * self.n_docs
        a, b = self.starts[lists][None, :], self.starts[lists + 1][None, :]
        low, bound, at = np.zeros(1, dtype=np.int64), *self._bounds(a, b, weights)
        scores, docs = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        wave = 8
        while len(bound):
            if len(bound) > wave:
                order = np.argpartition(-bound, wave)
            else:
                order = np.arange(len(bound))
            now, later = order[:wave], order[wave:]
            d = self.docs[at[now]]
            split = np.searchsorted(self.keys, base[None, :] + d[:, None])
            inside = split < len(self.keys)
            hit = inside & (self.keys[np.where(inside, split, 0)] == base[None, :] + d[:, None])
            own = (np.where(hit, self.impacts[np.where(inside, split, 0)], 0) * weights).sum(axis=1)
            scores, docs = np.append(scores, own), np.append(docs, d)
            kept = np.lexsort((docs, -scores))[:k]
            scores, docs = scores[kept], docs[kept]
            sides_a = np.concatenate([a[now], split + hit, a[later]])
            sides_b = np.concatenate([split, b[now], b[later]])
            n = 2 * len(now)
            fresh, fresh_at = self._bounds(sides_a[:n], sides_b[:n], weights)
            low = np.concatenate([low[now], d + 1, low[later]])
            bound, at = np.concatenate([fresh, bound[later]]), np.concatenate([fresh_at, at[later]])
            open_ = bound > 0
            if len(scores) == k:
                # A bound equal to the k-th score matters only before its document.
                open_ &= (bound > scores[-1]) | ((bound == scores[-1]) & (low < docs[-1]))
            a, b, low, bound, at = sides_a[open_], sides_b[open_], low[open_], bound[open_], at[open_]
            wave = min(WAVE, 2 * wave)
        return list(zip(scores.tolist(), docs.tolist(), strict=True))

    def _bounds(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bound of every interval (a row), and the place of the
        posting that adds most to it."""
        best = self.range_best(a, b)
        part = np.where(b > a, self.impacts[best] * weights, 0)
        most = part.argmax(axis=1)
        return part.sum(axis=1), best[np.arange(len(a)), most]


def _search_shard(postings: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """``[query, none, doc_id, row, score]`` of one shard."""
    columns = ["query", "none", "doc_id", "row", "score"]
    out = []
    if len(postings):
        # Documents in the order of ties: by id, those without one last, then by row.
        owners = postings.drop_duplicates("row")[["none", "doc_id", "row"]].sort_values(["none", "doc_id", "row"])
        place = pd.Series(np.arange(len(owners)), index=owners["row"].to_numpy())
        shard = Shard(postings["term_id"].to_numpy(), place.loc[postings["row"]].to_numpy(),
                      postings["impact"].to_numpy(), len(owners))
        for query, own in queries.groupby("query"):
            for score, doc in shard.search(own["term_id"].to_numpy(), own["weight"].to_numpy(), k):
                out.append((query, *owners.iloc[doc], score))
    return pd.DataFrame(out, columns=columns)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text", k: int = K) -> DataFrame:
    """``[query, id, rank, doc_id, score]``: the ``k`` best documents of every
    row of ``queries`` (``query`` numbers these rows)."""
    wanted = materialize(query_terms(queries, query_id, query_text), "queries")
    document = docs.sparkSession.createDataFrame([("",)], "term string")
    vocabulary = materialize(wanted.select("term").union(document).distinct(), "vocabulary")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text_col))
    found = materialize(rows.mapInArrow(_postings, POSTINGS).join(bounded(vocabulary), "term", "left_semi"), "postings")
    stats = found.where("tf = 0").agg(F.sum(F.when(F.col("n") > 0, 1)).alias("docs"),
                                      F.sum("n").alias("terms")).first()
    n_docs, n_terms = stats["docs"] or 0, max(stats["terms"] or 0, 1)
    postings = found.where("tf > 0")
    # floor(1000 ln((2N + 2) / (2 df + 1))): rare terms weigh most.
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    known = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms = materialize(known.select("term", "df", weight.alias("w"), F.monotonically_increasing_id().alias("term_id")),
                        "terms")
    shards = max(1, -(-(terms.agg(F.sum("df")).first()[0] or 0) // SHARD_POSTINGS))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    norm = F.expr(f"25 + (75 * n * {n_docs}) div {n_terms}")
    impact = F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)")
    placed = postings.join(bounded(terms.select("term", "term_id")), "term").withColumn("m", norm).select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "row", F.col("doc_id").isNull().alias("none"),
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "term_id", impact.alias("impact"))
    asked = wanted.join(bounded(terms.select("term", F.col("term_id").alias("asked"), "w")), "term").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), "query", F.col("asked").alias("term_id"),
        (F.col("w") * F.col("times")).alias("weight"))

    def each(postings: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _search_shard(postings, queries, k)

    best = materialize(placed.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        each, "query long, none boolean, doc_id long, row long, score long"), "best")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "none", "doc_id", "row")
    first = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = wanted.select("query", "id").distinct()
    ranked = materialize(first.join(ids, "query").select(
        "query", "id", "rank", F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "score"), "ranked")
    discard(wanted, vocabulary, found, terms, best)
    return ranked


#: The same rows in DuckDB SQL, by scoring every document for every item.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
p AS (SELECT r, term, any_value(len(w)) AS n, count(*) AS tf FROM (SELECT r, w, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM p GROUP BY ALL),
i AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
wq AS (
  SELECT i, item_id, term, times * floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM q JOIN df USING (term), s),
scored AS (
  SELECT i, item_id, r, sum(wq.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * p.n * s.n) // s.l)))) AS score
  FROM wq JOIN p USING (term), s GROUP BY ALL),
ranked AS (
  SELECT i, item_id, doc_id, score,
    row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank
  FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 10
"""
