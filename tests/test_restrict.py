"""Restriction by a big manifest and joint corpora of bucketed tables."""

import pytest
from pyspark.sql import functions as F

from conftest import ASM0, BYTES0, SF0001, VOCAB0, make_dataset, write
from corpusml.operators.restrict import likely_listed, restrict
from corpusml.plans import queries as Q
from corpusml.sources import bucketed_joint_corpus, ingest_buckets, load_corpus, read_manifest
from test_plans import plan_of


def test_filter_keeps_all_listed_and_the_join_removes_the_rest(spark):
    docs = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("hash"), "id",
                                      F.lit("x").alias("filter_bucket"), F.lit("y").alias("filter_bits"))
    listed = docs.where("id % 7 = 0").select("hash")
    want = {i for i in range(20_000) if i % 7 == 0}
    wide = {r["id"] for r in likely_listed(docs, listed, "hash").collect()}
    assert want <= wide and len(wide) < len(want) + 50
    # A filter far too small for its keys: false positives, and the same result.
    narrow = {r["id"] for r in likely_listed(docs, listed, "hash", bits=4096).collect()}
    assert want <= narrow and len(narrow) > len(want) + 1000
    exact = restrict(docs, listed.union(listed), "hash", bits=4096)
    assert exact.columns == docs.columns
    rows = exact.collect()
    assert sorted(r["id"] for r in rows) == sorted(want) and {(r[2], r[3]) for r in rows} == {("x", "y")}


def test_filter_types_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (-5, None), (2, "b"), (0, "z")], "k long, text string")
    listed = spark.createDataFrame([(1,), (1,), (None,), (-5,), (0,), (9,)], "k int")
    assert sorted(map(str, map(tuple, restrict(docs, listed, "k").collect()))) == sorted(
        map(str, [(1, "a"), (1, "a"), (-5, None), (0, "z")]))
    assert restrict(docs, listed.limit(0), "k").collect() == []
    assert restrict(docs.limit(0), listed, "k").collect() == []


def test_plans_of_filter_and_buckets(spark):
    """The filter is below the tokenizer; bucketed texts meet no exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, moved = plan_of(Q.queries()["manifest_filter"](spark, SF0001))
        lines = plan.splitlines()
        tokens = next(i for i, x in enumerate(lines) if "regexp_extract_all" in x)
        assert any("getbit" in x for x in lines[tokens + 1:]) and "SortMergeJoin" in plan
        assert all(not c & {"text", "features"} for c in moved)
        plan, moved = plan_of(Q.queries()["joint_corpus_buckets"](spark, SF0001))
        assert plan.count("SortMergeJoin") == 2 and moved == [{"id", "hash"}], moved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def files(scratch):
    docs = {f"h{i}": (BYTES0 if i % 3 else "", ASM0 if i % 4 else "") for i in range(30)}
    docs["odd 1%[x]"] = ("00401000 AA BB", ".text:00401000 mov eax, 1")
    return make_dataset(f"{scratch}/data", docs), [*docs, "h1", "", "h1"]


@pytest.mark.parametrize("prefilter", [False, True])
def test_bucketed_joint_corpus_equals_load_corpus(spark, scratch, files, prefilter):
    root, names = files
    write(f"{scratch}/x", "".join(n + "\n" for n in names[3:]))
    ingest_buckets(spark, root, f"joint_test_{int(prefilter)}", f"{scratch}/buckets", 5)
    manifest = read_manifest(spark, f"{scratch}/x").withColumn("extra", F.col("id") + 1)
    got = bucketed_joint_corpus(spark, manifest, f"joint_test_{int(prefilter)}", 5, VOCAB0).collect()
    want = load_corpus(spark, f"{scratch}/x", None, root, "joint", vocabulary=VOCAB0, prefilter=prefilter).collect()
    assert {r["id"]: r["features"] for r in got} == {r["id"]: r["features"] for r in want}
    assert len(got) == len(want) == len(names) - 4 and all(r["extra"] == r["id"] + 1 for r in got)
    lone = load_corpus(spark, f"{scratch}/x", None, root, "bytes", prefilter=prefilter)
    assert lone.count() == len(names) - 4


def test_bucketed_joint_corpus_without_a_document_fails(spark, scratch, files):
    ingest_buckets(spark, files[0], "joint_test_missing", f"{scratch}/buckets", 3)
    manifest = spark.createDataFrame([(0, "h1"), (1, "nope")], "id long, hash string")
    with pytest.raises(Exception, match="document not found: nope"):
        bucketed_joint_corpus(spark, manifest, "joint_test_missing", 3, VOCAB0).collect()
