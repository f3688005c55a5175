"""Benchmark decontamination as a prefix-filtered set join (native).

An item is cut into windows of ``WINDOW`` consecutive words (a shorter item
is one window); a window is the set of its ``SHINGLE``-word shingles with
their places.  A document contains a window exactly if it has all of these
shingles at the right distances, so for a containment of 1 the necessary
prefix is a single token:

1. one pass over the documents finds every occurrence of a benchmark
   shingle (the only pass that reads texts);
2. shingles are ordered by rarity, counted over all documents; the rarest of
   each window is its prefix token (a window with an absent one is out);
3. occurrences of prefix tokens give candidates ``(document, start,
   window)``, kept if the window fits: ``start >= 0`` (positional bound) and
   ``start + length <= n_words`` (length bound);
4. a candidate is verified by finding all its shingles at their places.

Only built-in DataFrame functions are used.  The benchmark's shingles are
broadcast to the document scan if they are at most ``SHINGLE_BYTES`` of
measured size; beyond that the same join is a shuffle join.

Defined cases: null texts have no words; items without words give no
window; repeated items count once by id, an item without an id has the id
''; repeated document rows are separate rows; empty tables give no rows or
clean rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import discard, is_bounded, materialize, text_or_empty

WINDOW = 10
SHINGLE = 4
SHINGLE_BYTES = 32 << 20
#: Word characters after lower-casing: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(col: str) -> Column:
    """The words of a text; only A-Z are lower-cased (``lower`` does just
    that, and faster, on texts without other letters)."""
    text = text_or_empty(col)
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def shingles(words_col: str, size: int) -> Column:
    """``array<struct<pos, shingle>>`` of all runs of ``size`` words."""
    def at(i: Column) -> Column:
        text = F.concat_ws(" ", *[F.col(words_col)[i + k] for k in range(size)])
        return F.struct(i.alias("pos"), text.alias("shingle"))

    places = F.when(F.size(words_col) >= size, F.sequence(F.lit(0), F.size(words_col) - size))
    return F.coalesce(F.transform(places, at), F.array().cast("array<struct<pos:int,shingle:string>>"))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """``[item, window, length, size]``: the distinct windows of each item
    as text; ``size`` is the shingle size (less for items shorter than it)."""
    item = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item")
    cut = items.select(item, words(text_col).alias("w")).where("size(w) > 0").withColumn(
        "length", F.least(F.size("w"), F.lit(window))).withColumn("size", F.least("length", F.lit(shingle)))
    starts = F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))).alias("at")
    return cut.select("item", "length", "size", "w", starts).select(
        "item", F.array_join(F.slice("w", F.col("at") + 1, F.col("length")), " ").alias("window"),
        "length", "size").distinct()


def _window_tokens(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``[window, length, tokens]``, one row per distinct window."""
    cut = windows.select("window", "length", "size").distinct().withColumn("w", F.split("window", " "))
    tokens = F.coalesce(*[F.when(F.col("size") == n, shingles("w", n)) for n in sizes])
    return cut.select("window", "length", tokens.alias("tokens"))


def occurrences(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, sizes: list[int]) -> DataFrame:
    """``[row, id, text_key, n_words, pos, shingle]``: every place of a
    wanted shingle, and one row per document with ``pos = -1``."""
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                      F.xxhash64(text_or_empty(text_col)).alias("text_key"), words(text_col).alias("w"))
    document = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("").alias("shingle")))
    everything = F.concat(document, *[shingles("w", n) for n in sizes])
    placed = cut.select("row", "id", "text_key", F.size("w").cast("long").alias("n_words"),
                        F.explode(everything).alias("s"))
    return placed.select("row", "id", "text_key", "n_words", "s.pos", "s.shingle").join(wanted, "shingle").select(
        "row", "id", "text_key", "n_words", "pos", "shingle")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """``(documents, hits)``: one row ``[row, id, text_key, n_words]`` per
    document, and ``[row, item, window, start, length]`` for every place
    where a window of an item occurs."""
    windows = materialize(benchmark_windows(items, item_id, item_text, window, shingle), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``shingle`` rows
    tokens = materialize(_window_tokens(windows, sizes or [shingle]), "tokens")
    wanted = tokens.select(F.explode("tokens.shingle").alias("shingle")).union(
        docs.sparkSession.createDataFrame([("",)], "shingle string")).distinct()
    wanted = materialize(wanted, "shingles")
    small = is_bounded(wanted, SHINGLE_BYTES)
    found = materialize(occurrences(docs, F.broadcast(wanted) if small else wanted, id_col, text_col, sizes),
                        "occurrences")
    places = found.where("pos >= 0").select("row", "n_words", "pos", "shingle")
    rarity = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.select("window", "length", "tokens", F.explode("tokens").alias("t")).join(
        rarity, F.col("t.shingle") == rarity["shingle"], "left")
    prefix = ranked.groupBy("window", "length", "tokens").agg(F.min(F.struct(
        F.coalesce("n", F.lit(0)).alias("n"), F.col("t.shingle").alias("shingle"), F.col("t.pos").alias("offset")))
        .alias("p")).where("p.n > 0")
    prefix = materialize(prefix.select("window", "length", "tokens", "p.shingle", "p.offset"), "prefix")
    start = F.col("pos") - F.col("offset")
    candidates = places.join(prefix, "shingle").where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
    expected = candidates.select("row", "window", "length", start.alias("start"), F.size("tokens").alias("needed"),
                                 F.explode("tokens").alias("t")).select(
        "row", "window", "length", "start", "needed", (F.col("start") + F.col("t.pos")).alias("pos"), "t.shingle")
    expected = materialize(expected, "candidates")
    verified = (expected.join(places.drop("n_words"), ["row", "pos", "shingle"])
                .groupBy("row", "window", "start", "length", "needed").agg(F.count(F.lit(1)).alias("n"))
                .where("n = needed"))
    hits = materialize(verified.select("row", "window", "start", "length").join(
        windows.select("item", "window"), "window"), "hits")
    discard(windows, tokens, wanted, prefix, expected)
    return found.where("pos < 0").select("row", "id", "text_key", "n_words"), hits


def report(documents: DataFrame, hits: DataFrame) -> DataFrame:
    """``[row, id, text_key, n_words, n_hit, n_items, items, contaminated]``
    per document; ``items`` is the sorted array of item ids as strings."""
    covered = (hits.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("p"))
               .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    items = hits.select("row", "item").distinct().groupBy("row").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    joined = documents.join(covered, "row", "left").join(items, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("row", "id", "text_key", "n_words", n_hit.alias("n_hit"),
                         F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                         (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no window of any item."""
    documents, hits = contamination(docs, items, id_col, text_col)
    bad = documents.join(hits.select("row").distinct(), "row", "left_semi").select(
        F.col("id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    bad = materialize(bad, "contaminated")
    same = docs[id_col].eqNullSafe(bad["_id"]) & (F.xxhash64(text_or_empty(text_col)) == bad["_key"])
    return docs.join(bad, same, "left_anti")


#: The same rows in DuckDB SQL, by comparing every window of every document.
ORACLE = r"""
WITH b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
n AS (SELECT item, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item, size, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) AS win FROM n),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
dw AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) AS win
  FROM d JOIN (SELECT DISTINCT size FROM win) ON len(w) >= size),
hit AS (SELECT doc_id, dw.size, pos, item FROM dw JOIN win ON dw.win = win.win AND dw.size = win.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM (SELECT DISTINCT doc_id, pos, size FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.list, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
