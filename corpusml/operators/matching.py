"""Joins of documents' tokens with tables of any size.

A frequent token is a hot key: it stands in most documents.  ``with_salt``
and ``salted`` split every key over ``SALTS`` join partitions: rows go to the
part their document falls into, the table's rows are repeated for every
part.  Spark still broadcasts the table when its own size check allows it.
``match_vocabulary`` measures its table and sends up to ``BROADCAST_BYTES``
to every task; beyond, its tokens are one row per word of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.functions.batches import with_listed_tokens
from corpusml.functions.tokens import SEGMENT_PATTERN, WORD_RUN_PATTERN, explode_tokens, extract_all
from corpusml.session import written

SALTS = 16
#: Largest vocabulary table that is broadcast: bytes of its words and ``WORD_BYTES`` for each.
BROADCAST_BYTES, WORD_BYTES = 32 << 20, 24
#: One entry of every document that is always kept, so that none is lost.
MARK = ":"


def with_salt(rows: DataFrame, id_col: str = "id", salts: int = SALTS) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))


def salted(table: DataFrame, salts: int = SALTS) -> DataFrame:
    return table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def match_vocabulary(docs: DataFrame, vocabulary: DataFrame, text_col: str = "text", id_col: str = "id",
                     salts: int = SALTS) -> DataFrame:
    """``[id, features]``: the ``asm`` tokens of every document (segment
    titles and vocabulary words, in order) for a vocabulary that is a table
    ``[word]`` of any size instead of a list in the plan.

    The vocabulary is written and measured first.  Up to ``BROADCAST_BYTES``
    every task has its words and cuts the texts batch by batch next to the
    scan: nothing is shuffled but the ids, to know which occur twice.  Beyond,
    candidates are exploded with their positions and meet it in a left join of
    salted words (segment titles pass, each under a key of its document); what
    is left is gathered per document in the order of positions.  ``id_col``
    identifies a row: rows of one id are gathered.  Null texts have no tokens."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = written(vocabulary.select(F.col("word").cast("string").alias("_key")).distinct(), "words")
    size = words.agg(F.sum(F.coalesce(F.octet_length("_key"), F.lit(0)) + WORD_BYTES)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return _match_in_tasks(docs, words)
    candidates = extract_all("text", f"(?:{SEGMENT_PATTERN})|(?:{WORD_RUN_PATTERN})")
    placed = docs.select("id", F.posexplode(F.concat(F.array(F.lit(MARK)), candidates)).alias("pos", "token"))
    words = words.withColumn("_known", F.lit(True))
    title = F.col("token").endswith(":")
    keyed = placed.withColumn("_key", F.when(title, F.concat("token", F.col("id").cast("string"))).otherwise(F.col("token")))
    joined = with_salt(keyed, salts=salts).join(salted(words, salts), ["_key", "_salt"], "left")
    kept = joined.where(title | F.col("_known")).select("id", "pos", "token")
    entries = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return kept.groupBy("id").agg(entries.alias("e")).select(
        "id", F.transform(F.slice("e", 2, F.greatest(F.size("e") - 1, F.lit(0))), lambda x: x["token"]).alias("features"))


def _match_in_tasks(docs: DataFrame, words: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(r["_key"] for r in words.where("_key IS NOT NULL").collect()))
    if docs.groupBy("id").count().where("count > 1").isEmpty():
        return with_listed_tokens(docs, ["text"], lambda: shared.value, pairs=False)
    rows = with_listed_tokens(docs, ["text"], lambda: shared.value, pairs=False, positions="pos")
    entries = F.sort_array(F.flatten(F.collect_list(F.arrays_zip("pos", "features"))))
    # As beyond the limit: one mark for every further row of an id.
    marks = F.array_repeat(F.lit(MARK), F.count(F.lit(1)).cast("int") - 1)
    return rows.groupBy("id").agg(marks.alias("m"), entries.alias("e")).select(
        "id", F.concat("m", F.transform("e", lambda x: x["features"])).alias("features"))


def document_terms(df: DataFrame, features: str = "features", id_col: str = "id") -> DataFrame:
    """``[id, term, cnt]``: the terms of every document, and one row with the
    term '' and the count 0 per document."""
    tokens = F.concat(F.array(F.lit("")), F.col(features))
    return explode_tokens(df.select(id_col, tokens.alias("t")), "t", "term", keep=(F.col(id_col).alias("id"),)).groupBy(
        "id", "term").agg(F.sum(_counts()).alias("cnt"))


def _counts() -> Column:
    return F.when(F.col("term") == "", F.lit(0)).otherwise(F.lit(1)).cast("long")
