"""Byte tokens and n-grams made batch by batch equal the column functions."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from corpusml.functions import batches
from corpusml.functions.batches import document_words, dumped_byte_tokens, dumped_texts, listed_tokens
from corpusml.functions.tokens import WORD_RUN_PATTERN, asm_tokens, byte_tokens, extract_all, joint_tokens, ngrams, with_line_break
from corpusml.functions.views import asm_listing, hex_dump
from corpusml.plans import queries as Q
from corpusml.plans import tables as tb

TEXTS = [None, "", "a", "é" * 7 + "xy", "x" * 16, "x" * 17, "\x00\n y" * 33, "🙂" * 40, " " * 15]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_dumped_byte_tokens_are_the_tokens_of_the_dump(spark, n):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string").repartition(2)
    got = {r["k"]: r["features"] for r in dumped_byte_tokens(docs, n).collect()}
    want = {r["k"]: r["f"] for r in docs.select("k", byte_tokens(hex_dump("text")).alias("f")).where("f IS NOT NULL")
            .select("k", ngrams("f", n).alias("f")).collect()}
    assert got == {0: None, **want}


def test_batches_of_many_tokens_are_cut(spark, monkeypatch):
    from corpusml.functions import batches
    monkeypatch.setattr(batches, "BATCH_TOKENS", 10)
    docs = spark.createDataFrame([(k, "ab" * k) for k in range(40)], "k long, text string").coalesce(1)
    assert {r["k"]: len(r["features"]) for r in dumped_byte_tokens(docs).collect()} == {k: 2 * k for k in range(40)}


def test_queries_that_read_every_byte_token_use_no_regex_per_byte(spark):
    for part in (None, "train", "test"):
        plan = tb.token_lists(spark, SF0001, part=part)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "regexp" not in plan
    for name in ("term_counts_uncapped", "nb_predict_bigrams", "nb_accuracy"):
        plan = Q.queries()[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "regexp" not in plan, name


def odd_listings(n: int = 1500) -> list[str]:
    """Texts of pieces that tokens are made of, and of those that spoil them."""
    rng = random.Random(7)
    pieces = ["AB", "0F", "a0", "C", "ABC", " ", " ", " ", "  ", ":", ".", "..", ":00401000", ":00401000 ", ":0040100G ",
              ":004010000 ", "00401000", "mov", "push_1", "é", "\n", "\t", "\x0b", "\u2028", "\x00", "AA BB", "_", ".text", "🙂"]
    return ["".join(rng.choices(pieces, k=rng.randrange(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("cut", [60, 4 << 20])
def test_listed_tokens_are_those_of_the_patterns(spark, monkeypatch, cut):
    monkeypatch.setattr(batches, "SLICE_BYTES", cut)
    odd = odd_listings()
    rows = [(k, a, b) for k, (a, b) in enumerate(zip([*TEXTS, *odd], [*reversed(odd), *TEXTS], strict=True))]
    docs = spark.createDataFrame(rows, "k long, a string, b string").coalesce(2)
    vocabulary = ["mov", "AB", "0F", "push_1", "00401000", "C"]
    words = frozenset(vocabulary)
    plain = docs.select("k", F.concat(joint_tokens(with_line_break("a"), vocabulary), joint_tokens("b", vocabulary)).alias("f"))
    broken = docs.select("k", with_line_break("a").alias("a"), "b")
    found = batches.with_listed_tokens(broken, ["a", "b"], lambda: words, pairs=True)
    assert {r["k"]: r["features"] for r in found.collect()} == {r["k"]: r["f"] for r in plain.collect()}
    plain = docs.select("k", asm_tokens("a", vocabulary).alias("f"))
    found = batches.with_listed_tokens(docs.select("k", "a"), ["a"], lambda: words, pairs=False)
    assert {r["k"]: r["features"] for r in found.collect()} == {r["k"]: r["f"] for r in plain.collect()}
    dumps = {r["k"]: r["text"] for r in dumped_texts(docs.select("k", F.col("a").alias("text"))).collect()}
    assert dumps == {r["k"]: r["d"] for r in docs.select("k", hex_dump("a").alias("d")).collect()}
    counted = document_words(docs.select(F.col("b").alias("text"))).groupBy("word").agg(F.sum("n").alias("n"))
    each = docs.select(F.explode(F.array_distinct(extract_all("b", WORD_RUN_PATTERN))).alias("word")).groupBy("word").count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, each.collect()))


def test_positions_count_all_candidates():
    lists, positions = listed_tokens([[b"x mov y"], [None], [b""], [b".t:00401000 mov"]], {"mov"}, 3, False)
    assert lists.to_pylist() == [["mov"], None, [], [".t:", "mov"]]
    assert positions.to_pylist() == [[1], None, [], [0, 2]]


def test_big_token_lists_of_documents_need_no_regex(spark):
    """one pass of numpy over the texts; no row per word, no list of tokens in an exchange."""
    for name in ("asm_vocabulary_table", "joint_corpus_buckets"):
        plan = Q.queries()[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "regexp" not in plan and "Generate" not in plan, name
