"""Source divergence audit by iceberg prefix refinement.

Which sources of a language speak differently from the others, and in which
terms?  Only terms in at least ``MIN_DOCS`` documents of a language count.
They are found without gathering the long tail of rare terms:

1. texts are read byte-wise (UTF-8 bytes as Latin-1 characters) and cut once;
   the terms of some ``SLICE_BYTES`` of documents, each with an end mark, are
   written once for a language, with its documents and a list of the
   occurrences and documents per source;
2. level by level, the term prefixes of ``n`` bytes (``n`` doubles per level)
   that extend a prefix alive at the level before are counted per language, by
   the documents of their terms, and prefixes below the threshold are
   discarded with all that extend them;
3. the "prefix" of a term shorter than ``n`` ends with the mark, so its count
   is that of the complete term: it is kept or gone.  The levels end when no
   open prefix is alive.

A document with two terms counts twice for their common prefix: an open
prefix has at least the documents of each of its terms, so none is discarded
wrongly, and a complete term has its documents exactly.  Slices hold whole
documents, so their sums need no distinct and no shuffle.
The living prefixes are broadcast after their size has been measured; beyond
the limit (``common.BROADCAST_BYTES``) the counts are summed first and then
joined with them, with equal results.

Kept terms and groups are numbered when they are written; counts are summed,
joined and paired by these numbers, and names return at the end.

The divergence of two sources is summed sparsely: with ``f`` the distance of
two smoothed frequencies and ``0`` the frequency of an absent term,

    sum f(p, q) = V f(0, 0) + sum over terms of the first [f(p, 0) - f(0, 0)]
                + sum over terms of the second [f(0, q) - f(0, 0)]
                + sum over shared terms [f(p, q) - f(p, 0) - f(0, q) + f(0, 0)]

so no source x vocabulary grid is made.  All arithmetic is integer.

Defined cases: null text, lang and source are ''; a text without terms still
makes its group occur; repeated rows are separate documents; a language
without kept terms has divergences of 0; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusml.functions.batches import spans
from corpusml.llm.common import bounded, discard, is_bounded, materialize, text_or_empty

MIN_DOCS = 10
TOP_TERMS = 10
#: Bytes of the first level's prefixes; every level doubles them.
FIRST_PREFIX = 8
END = "\x00"
SCALE = 1_000_000_000
#: Counts up to this are multiplied by ``SCALE`` in a long.
LONG_COUNT = 9_000_000_000
TERM_SLICES = "lang string, term string, docs long, sources array<struct<source:string,n:long,docs:long>>"
# Of the bytes of a term, A-Z are lower-cased; all but ASCII
# letters and bytes beyond ASCII separate terms.
LETTERS = bytes(b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b > 0x7F else 0 for b in range(256))
#: Bytes of the texts that are cut and summed together (one more document may follow).
SLICE_BYTES = 8 << 20


def from_byte_view(col: Column) -> Column:
    return F.decode(F.encode(col, "ISO-8859-1"), "UTF-8")


def _term_sums(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    """``TERM_SLICES`` of some documents ``(lang, source, text)``."""
    langs: dict[str, int] = {}
    groups: dict[tuple[str, str], int] = {}
    group = np.array([groups.setdefault(r[:2], len(groups)) for r in rows], dtype=np.int64)
    lang = np.array([langs.setdefault(g[0], len(langs)) for g in groups], dtype=np.int64)
    parts = [t.encode().translate(LETTERS).decode("latin-1").encode() + b"\0" for _, _, t in rows]
    data = np.frombuffer(b"\0" + b"".join(parts), dtype=np.uint8)
    edge = np.flatnonzero((data[1:] != 0) != (data[:-1] != 0)) + 1
    begin = 1 + np.cumsum([0] + [len(p) for p in parts[:-1]], dtype=np.int64)
    doc = np.searchsorted(begin, edge[::2], side="right") - 1
    coded = spans(data, edge[::2], edge[1::2] + 1).dictionary_encode()  # a zero byte, END, follows each
    code, none = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    width = none + 1  # the last code: no term
    keyed = pa.array(group[doc] * width + code).dictionary_encode()
    key, found = keyed.indices.to_numpy(), keyed.dictionary.to_numpy()
    # Numbers are given in the order of appearance: a greater one is new to its document.
    own = pa.array(doc * width + code).dictionary_encode().indices.to_numpy()
    new = np.flatnonzero(np.diff(np.maximum.accumulate(own), prepend=-1)) if len(own) else own
    # Every group also occurs without a term, with counts of 0.
    found = np.concatenate([found, np.arange(len(groups)) * width + none])
    n, docs = (np.bincount(k, minlength=len(found)).astype(np.int64) for k in (key, key[new]))
    row = lang[found // width] * width + found % width
    order = np.argsort(row, kind="stable")
    row, found, n, docs = row[order], found[order], n[order], docs[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    sources = pa.StructArray.from_arrays(
        [pa.array([g[1] for g in groups], pa.string()).take(pa.array(found // width)), pa.array(n), pa.array(docs)],
        names=["source", "n", "docs"])
    terms = pa.concat_arrays([coded.dictionary, pa.nulls(1, pa.string())])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(langs), pa.string()).take(pa.array(row[first] // width)),
         terms.take(pa.array(row[first] % width)), pa.array(np.add.reduceat(docs, first)),
         pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), sources)],
        names=["lang", "term", "docs", "sources"])


def _term_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.append(row)
            size += len(row[2])
            if size >= SLICE_BYTES:
                yield _term_sums(rows)
                rows, size = [], 0
    if rows:
        yield _term_sums(rows)


def term_slices(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``TERM_SLICES``: the terms of some documents at a time, byte-wise and
    marked, with their documents in a language and their counts per source;
    a row without a term lists the groups that occur."""
    rows = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                       text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_term_slices, TERM_SLICES)


def by_source(slices: DataFrame) -> DataFrame:
    """``[lang, term, source, n, docs]`` of term slices."""
    return slices.select("lang", "term", F.inline("sources"))


def term_lists(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``term_slices`` with a row for each source."""
    return by_source(term_slices(docs, text_col, lang_col, source_col))


def _summed(rows: DataFrame, keys: list[str], total: Column, alive: DataFrame | None, on: list[str]) -> DataFrame:
    """``[*keys, n]``: ``total`` of the rows with a partner in ``alive``."""
    if alive is None:
        return rows.groupBy(*keys).agg(total.alias("n"))
    alive = alive.select(*on)
    if is_bounded(alive):
        return rows.join(F.broadcast(alive), on, "left_semi").groupBy(*keys).agg(total.alias("n"))
    # Too many to send to every task: sums are small rows that can meet them.
    kept = [F.first(c).alias(c) for c in on if c not in keys]  # these depend on the keys
    return rows.groupBy(*keys).agg(total.alias("n"), *kept).join(alive.hint("merge"), on, "left_semi").select(*keys, "n")


def kept_terms(lists: DataFrame, min_docs: int = MIN_DOCS, first: int = FIRST_PREFIX) -> DataFrame:
    """``[lang, term, n_docs, id]``: the (byte-wise, marked) terms in at least
    ``min_docs`` documents of a language, by prefixes refined level by level,
    numbered.  ``lists``: term slices, or lists with a row for each source."""
    alive, done, used = None, [], []
    above, size = 0, first
    while True:
        rows = lists.where(F.length("term") > above).select(
            "lang", F.substring("term", 1, size).alias("prefix"), F.substring("term", 1, above).alias("stem"), "docs")
        counted = _summed(rows, ["lang", "prefix"], F.sum("docs"), alive, ["lang", "stem"])
        level = materialize(counted.where(F.col("n") >= min_docs), f"prefixes_{size}")
        used.append(level)
        complete = F.col("prefix").endswith(END)
        done.append(level.where(complete))
        alive = level.where(~complete).select("lang", F.col("prefix").alias("stem"))
        if alive.isEmpty():
            break
        above, size = size, size * 2
    found = done[0]
    for part in done[1:]:
        found = found.unionAll(part)
    kept = materialize(found.select("lang", F.col("prefix").alias("term"), F.col("n").alias("n_docs"),
                                    F.monotonically_increasing_id().alias("id")), "kept")
    discard(*used)
    return kept


def smoothed(count: str, total: str, terms: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``, exactly:
    in longs while they hold the product, in decimals beyond."""
    wide = (f"cast({SCALE} as decimal(18,0)) * (cast({count} as decimal(19,0)) + 2) "
            f"div (cast({total} as decimal(20,0)) + 2 * cast({terms} as decimal(19,0)))")
    short = f"(cast({SCALE} as bigint) * ({count} + 2)) div ({total} + 2 * {terms})"
    return F.expr(f"1 + CASE WHEN {count} < {LONG_COUNT} AND {total} < {LONG_COUNT << 20} AND {terms} < {LONG_COUNT} "
                  f"THEN {short} ELSE cast({wide} as bigint) END")


def distance(p: str, q: str) -> Column:
    """``floor((p - q)^2 / (p + q))`` of two bigint columns."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def _term_counts(slices: DataFrame, kept: DataFrame) -> DataFrame:
    """``[id, lang, source, n]``: occurrences of the kept terms in a group."""
    slices = slices.where("term IS NOT NULL")
    ids = kept.select("lang", "term", "id")
    if is_bounded(ids):
        numbered = slices.join(F.broadcast(ids), ["lang", "term"]).select("id", "lang", F.inline("sources"))
        return numbered.groupBy("id", "lang", "source").agg(F.sum("n").alias("n"))
    # Too many to send to every task: sums are small rows that can meet them.
    sums = by_source(slices).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    return sums.join(ids.hint("merge"), ["lang", "term"]).select("id", "lang", "source", "n")


def frequencies(slices: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(groups, counts)``: ``[g, lang, source, total, terms, p0]`` for every
    group, numbered (``p0``: frequency of an absent term, null without kept
    terms), and ``[id, g, lang, n, p, p0]`` for every kept term that a group
    has."""
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    counts = materialize(_term_counts(slices, kept), "counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (by_source(slices.where("term IS NULL")).select("lang", "source").distinct()
              .join(vocabulary, "lang", "left").join(totals, ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                      F.coalesce("terms", F.lit(0)).alias("terms")))
    p0 = F.when(F.col("terms") > 0, smoothed("0", "total", "terms"))
    groups = materialize(groups.select(F.monotonically_increasing_id().alias("g"), "*", p0.alias("p0")), "groups")
    with_p = counts.join(bounded(groups), ["lang", "source"]).select(
        "id", "g", "lang", "n", smoothed("n", "total", "terms").alias("p"), "p0")
    with_p = materialize(with_p, "frequencies")
    discard(counts)
    return groups, with_p


def pair_divergence(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """``[lang, source, other, p0, q0, value]`` for every ordered pair of
    sources of a language."""
    other = groups.select("lang", F.col("g").alias("h"), F.col("source").alias("other"), F.col("p0").alias("q0"))
    pairs = groups.select("lang", "g", "source", "terms", "p0").join(other, "lang").where("g <> h")
    # Terms of one side only: equal counts have equal frequencies.
    histogram = counts.groupBy("g", "p").agg(F.count(F.lit(1)).alias("k"))
    own = histogram.join(pairs.select("g", "h", "p0", "q0"), "g").groupBy("g", "h").agg(
        F.sum(F.col("k") * (distance("p", "q0") - distance("p0", "q0"))).alias("v"))
    mirrored = own.select(F.col("h").alias("g"), F.col("g").alias("h"), "v")
    # The same columns on both sides: they are shuffled once.
    one, two = counts.select("id", "g", "p", "p0").alias("a"), counts.select("id", "g", "p", "p0").alias("b")
    both = one.join(two, F.expr("a.id = b.id AND a.g < b.g")).groupBy(
        F.col("a.g").alias("g"), F.col("b.g").alias("h")).agg(
        F.sum(distance("a.p", "b.p") - distance("a.p", "b.p0") - distance("a.p0", "b.p")
              + distance("a.p0", "b.p0")).alias("v"))
    both = materialize(both, "shared")
    turned = both.select(F.col("h").alias("g"), F.col("g").alias("h"), "v")
    parts = own.unionByName(mirrored).unionByName(both).unionByName(turned).groupBy("g", "h").agg(
        F.sum("v").alias("v"))
    absent = F.when(F.col("terms") > 0, F.col("terms") * distance("p0", "q0")).otherwise(F.lit(0))
    return pairs.join(parts, ["g", "h"], "left").select(
        "lang", "source", "other", (absent + F.coalesce("v", F.lit(0))).alias("value"))


def term_divergence(groups: DataFrame, counts: DataFrame, kept: DataFrame, top_terms: int = TOP_TERMS) -> DataFrame:
    """``[lang, source, term, value]``: kept terms that a group uses more
    than its language does, the ``top_terms`` of a group and all with the
    value of the last."""
    lang_terms = counts.groupBy("id", "lang").agg(F.sum("n").alias("n_lang"))
    totals = materialize(groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms")),
                         "langs")
    q = materialize(lang_terms.join(bounded(totals), "lang").select(
        "id", smoothed("n_lang", "total", "terms").alias("q")), "lang_terms")
    over = counts.select("id", "g", "p").join(bounded(q), "id").where("p > q").select(
        "id", "g", distance("p", "q").alias("value"))
    best = F.rank().over(Window.partitionBy("g").orderBy(F.col("value").desc()))
    over = over.withColumn("best", best).where(F.col("best") <= top_terms)
    plain = from_byte_view(F.expr("substring(term, 1, length(term) - 1)"))
    return over.join(kept.select("id", plain.alias("term")), "id").join(
        groups.select("g", "lang", "source"), "g").select("lang", "source", "term", "value")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``[lang, source, part, item, value, rank]``: per group the other
    sources of its language by divergence (part ``pair``, all of them) and
    its most over-used terms (part ``term``, the first ``top_terms``)."""
    slices = materialize(term_slices(docs, text_col, lang_col, source_col), "terms")
    kept = kept_terms(slices, min_docs)
    groups, counts = frequencies(slices, kept)
    discard(slices)
    pairs = pair_divergence(groups, counts).select("lang", "source", F.lit("pair").alias("part"),
                                                   F.col("other").alias("item"), "value")
    terms = term_divergence(groups, counts, kept, top_terms).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    ranked = materialize(pairs.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top_terms)),
                         "audit")
    discard(kept, groups, counts)
    return ranked


#: The same rows in DuckDB SQL, over the whole grid of sources and kept terms.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) + 1 AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
lt AS (SELECT lang, sum(total) AS total FROM g GROUP BY ALL),
q AS (
  SELECT lang, term, (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(lt.total) + 2 * any_value(v)) + 1 AS q
  FROM c JOIN lt USING (lang) JOIN v USING (lang) GROUP BY ALL),
pv AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
