"""Line dedup over overlapping three-line windows.

Every run of ``WINDOW`` consecutive lines is a window, known by two 64-bit
hashes.  The first occurrence of a window in the corpus (by id, then row,
then line) stays; the lines that later occurrences cover are removed.  Of a
window that overlaps its own first occurrence, lines of that first
occurrence stay.

Windows are pre-aggregated (first place and count) before their shuffle and
only repeated ones are joined back, so a passage in a third of all documents
costs one row per task there, and its occurrences are an ordinary skewed
join that Spark may split.

Defined cases: null text is an empty text; lines end at line feeds only;
texts of fewer lines than a window have none and stay; windows of lines that
hold nothing but spaces are ignored; of repeated rows the first stays whole;
an empty table gives no rows; other columns pass through whatever their
names are (a count whose name is taken gets a leading ``_``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import free_names, materialize, text_or_empty

WINDOW = 3
#: Second hash: other start value, so the pair acts as 128 bits.
SECOND = 7919


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """``[h1, h2, id, row, line]``: one row per window of ``rows [row, id,
    text]``."""
    def window(i):
        own = [F.col("_lines")[i + k] for k in range(size)]
        blank = F.trim(F.concat(*own)) == ""
        return F.when(~blank, F.struct(F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(SECOND), *own).alias("h2")))

    lines = rows.select("id", "row", F.split("text", "\n", -1).alias("_lines"))
    starts = F.when(F.size("_lines") >= size, F.sequence(F.lit(0), F.size("_lines") - size))
    found = lines.select("id", "row", F.posexplode(F.transform(starts, window)).alias("line", "w"))
    return found.where("w IS NOT NULL").select("w.h1", "w.h2", "id", "row", "line")


def covered_runs(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """``[row, runs]``: for each of ``rows [row, id, text]`` with repeated windows the (unmerged)
    line ranges ``[start, end]`` of later occurrences."""
    windows = _windows(rows, size)
    place = F.struct("id", "row", "line")
    repeated = materialize(windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                           .where("n > 1").drop("n"), "repeated_windows")
    later = windows.join(repeated, ["h1", "h2"]).where((F.col("row") != F.col("first.row"))
                                                      | (F.col("line") != F.col("first.line")))
    start = F.when(F.col("row") == F.col("first.row"), F.greatest("line", F.col("first.line") + size)).otherwise(
        F.col("line"))
    return later.groupBy("row").agg(F.collect_list(F.array(start, F.col("line") + size - 1)).alias("runs"))


def _without(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
    rows = []
    for text, own in zip(texts, runs, strict=True):
        if text is None or own is None:
            rows.append((None, 0, 0))
            continue
        lines = np.array(text.split("\n"), dtype=object)
        edge = np.zeros(len(lines) + 1, dtype=np.int64)
        bounds = np.array([list(r) for r in own], dtype=np.int64)
        np.add.at(edge, bounds[:, 0], 1)
        np.add.at(edge, bounds[:, 1] + 1, -1)
        gone = np.cumsum(edge)[:-1] > 0
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        rows.append(("\n".join(lines[~gone]), int(gone.sum()), spans))
    return pd.DataFrame(rows, columns=["text", "n_removed", "n_spans"])


def count_columns(docs: DataFrame) -> list[str]:
    """The names of the counts that ``dedup_lines`` adds to ``docs``."""
    return free_names(docs, "n_lines", "n_removed", "n_spans")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from ``text_col``, plus
    ``n_lines``, ``n_removed`` and ``n_spans`` (maximal removed runs); see
    ``count_columns`` for their names where ``docs`` has such columns."""
    rows = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
        F.struct("*").dropFields(f"`{text_col}`").alias("doc")), "numbered")
    joined = rows.join(covered_runs(rows, size), "row", "left")
    without = F.pandas_udf(_without, "text string, n_removed long, n_spans long")
    cut = joined.withColumn("cut", without(F.when(F.col("runs").isNotNull(), F.col("text")), "runs"))
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    counts = [lines, F.coalesce("cut.n_removed", F.lit(0)), F.coalesce("cut.n_spans", F.lit(0))]
    kept = [F.coalesce("cut.text", "text").alias(c) if c == text_col else F.col("doc")[c] for c in docs.columns]
    return cut.select(*[k.alias(c) for k, c in zip(kept, docs.columns, strict=True)],
                      *[n.cast("long").alias(c) for n, c in zip(counts, count_columns(docs), strict=True)])


#: The same rows in DuckDB SQL.
ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS a,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line
  FROM documents),
w AS (
  SELECT *, lead(a, 1) OVER d AS b, lead(a, 2) OVER d AS c FROM l
  WINDOW d AS (PARTITION BY doc_id ORDER BY line)),
o AS (
  SELECT doc_id, line, first_value(doc_id) OVER f AS first_doc, first_value(line) OVER f AS first_line,
         row_number() OVER f AS nth
  FROM w WHERE c IS NOT NULL AND trim(a || b || c) <> ''
  WINDOW f AS (PARTITION BY a, b, c ORDER BY doc_id, line)),
r AS (
  SELECT DISTINCT doc_id, unnest(generate_series(
      CASE WHEN first_doc = doc_id THEN greatest(line, first_line + 3) ELSE line END, line + 2)) AS line
  FROM o WHERE nth > 1),
m AS (
  SELECT l.doc_id, l.line, l.a, r.line IS NOT NULL AS gone,
         coalesce(lag(r.line IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.line), false) AS gone_before
  FROM l LEFT JOIN r ON l.doc_id = r.doc_id AND l.line = r.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       count(*) FILTER (WHERE gone AND NOT gone_before) AS n_spans,
       sha256(coalesce(string_agg(a, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
