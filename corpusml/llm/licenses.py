"""License scan by diagonal voting (native).

A template is a notice or phrase of known words.  A copy of it in a document
shows as word k-grams whose document place minus template place (the
diagonal) is the same:

1. one pass over the texts hashes all rolling k-grams of every document (k is
   ``K``, or the template's length if that is less) and joins them to the
   templates' positions; the only rows that leave the pass are hits and one
   row per document;
2. hits are counted per document, template and diagonal, with the range of
   places they cover;
3. diagonals at most ``length // DRIFT`` apart are neighbours and become one
   span (words were inserted or left out); phrases are too short to drift;
4. a span with enough votes is verified on the words of the document: the
   template's very words score 1; otherwise the score is the smaller of the
   share of the template's places that the votes stand for (``votes + k - 1``
   of one run) and the share of its different words that the span holds.
   Templates of fewer than ``DRIFT`` words have to stand word for word.

The base labels are the phrases that stand word for word (score 1).  The
method adds the label of every template with a span of at least
``MIN_SCORE``.  Only built-in DataFrame functions are used.

Defined cases: null texts have no words and no labels; repeated rows are
separate rows with equal results; a null id is an id; an empty table gives no
rows; without templates nothing is found; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusml.llm.common import bounded, discard, materialize, text_or_empty
from corpusml.llm.decontaminate import words

K = 4
#: A template of so many words may shift by one word.
DRIFT = 10
MIN_SCORE = 0.8


class Template(NamedTuple):
    name: str
    label: str
    text: str
    base: bool = False


# The phrases of the contract, and the notices by which the
# common licenses ask to be named.
PHRASES = (
    Template("gpl phrase", "gpl", "gnu general public license", True),
    Template("apache phrase", "apache", "apache license", True),
    Template("cc-by phrase", "cc-by", "cc by", True),
    Template("mit phrase", "mit", "mit license", True),
)
NOTICES = (
    Template("apache 2.0", "apache-2.0", "Apache License, Version 2.0"),
    Template("apache 2.0 notice", "apache-2.0",
             "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at"),
    Template("gpl 2", "gpl-2.0", "GNU General Public License, version 2"),
    Template("gpl 3", "gpl-3.0", "GNU General Public License, version 3"),
    Template("gpl notice", "gpl-notice",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version."),
    Template("lgpl", "lgpl", "GNU Lesser General Public License"),
    Template("agpl", "agpl", "GNU Affero General Public License"),
    Template("mit notice", "mit-notice",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
             "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
             "copies of the Software"),
    Template("bsd notice", "bsd",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met"),
    Template("isc notice", "isc",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl 2.0", "mpl-2.0", "Mozilla Public License, v. 2.0"),
    Template("cc by-nc", "cc-by-nc", "CC BY-NC 4.0"),
    Template("cc by-sa", "cc-by-sa", "CC BY-SA 4.0"),
    Template("cc by-nd", "cc-by-nd", "CC BY-ND 4.0"),
    Template("cc by 4.0", "cc-by-4.0", "Creative Commons Attribution 4.0 International"),
)
TEMPLATES = PHRASES + NOTICES


def gram_hashes(words_col: str, k: int) -> Column:
    """``array<long>``: the hash of every run of ``k`` words."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(words_col) - k),
                         lambda i: F.xxhash64(F.lit(k), *[F.col(words_col)[i + j] for j in range(k)]))
    return F.when(F.size(words_col) >= k, hashed).otherwise(F.array().cast("array<bigint>"))


def template_table(spark: SparkSession, templates: Iterable[Template], k: int) -> DataFrame:
    """``[template, label, base, w, k]``: the templates that have words."""
    rows = [(n, t.label, t.text, t.base) for n, t in enumerate(templates)]
    cut = spark.createDataFrame(rows, "template int, label string, text string, base boolean")
    return cut.select("template", "label", "base", words("text").alias("w")).where("size(w) > 0").withColumn(
        "k", F.least(F.size("w"), F.lit(k)))


def _positions(table: DataFrame, sizes: list[int]) -> DataFrame:
    """``[hash, template, place, k]``: every k-gram of every template."""
    hashes = F.coalesce(*[F.when(F.col("k") == k, gram_hashes("w", k)) for k in sizes])
    return table.select("template", "k", F.posexplode(hashes).alias("place", "hash"))


def hits(docs: DataFrame, positions: DataFrame, sizes: list[int], id_col: str, text_col: str) -> DataFrame:
    """``[row, id, text_key, n_words, template, place, pos, k]``: every
    k-gram of a document that a template has at ``place``; and one row per
    document with no template."""
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                      F.xxhash64(text_or_empty(text_col)).alias("text_key"), words(text_col).alias("w"))
    document = F.array(F.lit(0).cast("long"))
    cut = cut.select("row", "id", "text_key", F.size("w").alias("n_words"),
                     F.concat(document, *[gram_hashes("w", k) for k in sizes]).alias("hashes"))
    placed = cut.select("row", "id", "text_key", "n_words", F.posexplode("hashes").alias("at", "hash"))
    # The document's own entry comes first, then the k-grams of each size.
    first, pos = F.lit(1), F.lit(None).cast("int")
    for k in sizes:
        pos = F.coalesce(pos, F.when(F.col("k") == k, F.col("at") - first))
        first = first + F.greatest(F.col("n_words") - (k - 1), F.lit(0))
    marker = positions.sparkSession.createDataFrame(
        [(0, None, None, None)], "hash long, template int, place int, k int")
    index = materialize(marker.unionByName(positions), "positions")
    # A hash of 0 is the document's entry, and only where that entry is.
    joined = placed.join(bounded(index), "hash").where((F.col("at") == 0) == F.col("template").isNull())
    found = materialize(joined.select("row", "id", "text_key", F.col("n_words").cast("long"), "template", "place",
                                      pos.alias("pos"), "k"), "hits")
    discard(index)
    return found


def required(length: Column, drift: int, min_score: float) -> Column:
    """The score that a template of so many words needs."""
    return F.when(length < drift, F.lit(1.0)).otherwise(F.lit(min_score))


def spans(found: DataFrame, table: DataFrame, drift: int, min_score: float) -> DataFrame:
    """``[id, text_key, template, start, stop, places]``: merged diagonals
    with enough votes, which stand for ``places`` words of the template."""
    diagonal = F.col("pos") - F.col("place")
    voted = found.where("template IS NOT NULL").withColumn("diagonal", diagonal).groupBy(
        "row", "id", "text_key", "template", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("start"), F.max(F.col("pos") + F.col("k")).alias("stop"))
    sized = voted.join(F.broadcast(table.select("template", "k", F.size("w").alias("length"))), "template")
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by)
    fresh = F.when(gap <= F.floor(F.col("length") / drift), 0).otherwise(1)
    merged = (sized.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(by))
              .groupBy("row", "id", "text_key", "template", "length", "k", "span")
              .agg(F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("stop").alias("stop")))
    # A run of hits covers k - 1 places more than it has votes.
    places = F.least(F.col("votes") + F.col("k") - 1, F.col("length"))
    enough = F.col("length") * required(F.col("length"), drift, min_score)
    return merged.withColumn("places", places).where(F.col("places") >= enough).select(
        "id", "text_key", "template", "start", "stop", "places").distinct()


def verified(docs: DataFrame, candidates: DataFrame, table: DataFrame, id_col: str, text_col: str,
             drift: int, min_score: float) -> DataFrame:
    """``[id, text_key, template, label, base, start, stop, score]``: the
    candidates whose words are the template's; only texts with candidates
    are cut into words again."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("text_key"),
                        F.col(text_col).alias("text"))
    wanted = candidates.select(F.col("id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    texts = texts.join(bounded(materialize(wanted, "texts")),
                       F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi")
    spans_of = candidates.groupBy("id", "text_key").agg(
        F.collect_list(F.struct("template", "start", "stop", "places")).alias("spans"))
    cut = texts.select("id", "text_key", words("text").alias("w")).alias("t").join(
        spans_of.alias("s"), F.expr("t.id <=> s.id AND t.text_key = s.text_key")).select("t.id", "t.text_key", "w", "spans")
    part = F.transform("spans", lambda s: F.struct(
        s["template"].alias("template"), s["start"].alias("start"), s["stop"].alias("stop"),
        s["places"].alias("places"), F.slice("w", s["start"] + 1, s["stop"] - s["start"]).alias("own")))
    rows = cut.select("id", "text_key", F.explode(part).alias("s")).select("id", "text_key", "s.*")
    rows = rows.join(F.broadcast(table), "template")
    shared = F.size(F.array_intersect("w", "own")) / F.size(F.array_distinct("w"))
    score = F.when(F.col("own") == F.col("w"), F.lit(1.0)).otherwise(
        F.least(F.col("places") / F.size("w"), shared, F.lit(0.999)))
    return rows.withColumn("score", score).where(F.col("score") >= required(F.size("w"), drift, min_score)).select(
        "id", "text_key", "template", "label", "base", "start", "stop", "score").distinct()


def scan(docs: DataFrame, templates: Iterable[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
         k: int = K, drift: int = DRIFT, min_score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """``(documents, spans)``: one row ``[row, id, text_key, n_words]`` per
    document and ``[id, text_key, template, label, base, start, stop,
    score]`` for every verified span (words from 0, ``stop`` exclusive)."""
    table = template_table(docs.sparkSession, templates, k)
    sizes = sorted(r["k"] for r in table.select("k").distinct().collect())  # at most ``k`` rows
    table = materialize(table, "templates")
    found = hits(docs, _positions(table, sizes or [k]), sizes or [k], id_col, text_col)
    candidates = materialize(spans(found, table, drift, min_score), "candidates")
    accepted = materialize(verified(docs, candidates, table, id_col, text_col, drift, min_score), "spans")
    discard(table, candidates)
    return found.where("template IS NULL").select("row", "id", "text_key", "n_words"), accepted


def report(documents: DataFrame, accepted: DataFrame) -> DataFrame:
    """``[id, n_words, n_base, first_word, last_word, base_labels, labels,
    score]`` per document: a base place is a phrase found word for word."""
    exact = F.col("base") & (F.col("score") == 1.0)
    place = F.when(exact, F.col("start").cast("long"))
    labels = accepted.groupBy("id", "text_key").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    joined = documents.alias("d").join(labels.alias("l"), F.expr("d.id <=> l.id AND d.text_key = l.text_key"), "left")
    return joined.select(
        "d.id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
