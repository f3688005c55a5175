"""Vocabulary, count vectors, idf, the feature pipeline, labels."""

import math

import pytest
from pyspark.ml.feature import IDF, CountVectorizer, NGram, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusml.operators import (
    FeaturePipeline, OrderedCountVectorizer, build_vocabulary, filtered_stats, idf_weights, index_labels,
    label_dictionary, label_indexer, term_counts, term_stats, tfidf, vector_counts, vocabulary_terms,
)


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(0, ["a", "b", "a"]), (1, ["b", "c"]), (2, ["c", "d"])],
                                 "id long, features array<string>")


def test_term_stats(docs):
    got = {r.term: (r.tf, r.df) for r in term_stats(docs).collect()}
    assert got == {"a": (2, 1), "b": (2, 2), "c": (2, 2), "d": (1, 1)}


def test_vocabulary_order_and_min_df(docs):
    assert vocabulary_terms(build_vocabulary(docs)) == ["a", "b", "c", "d"]
    assert vocabulary_terms(build_vocabulary(docs, min_df=2)) == ["b", "c"]
    assert vocabulary_terms(build_vocabulary(docs, min_df=0.5)) == ["b", "c"]
    assert vocabulary_terms(build_vocabulary(docs, max_df=1)) == ["a", "d"]
    assert vocabulary_terms(build_vocabulary(docs, vocab_size=2)) == ["a", "b"]


def test_ordered_count_vectorizer_matches_ml(docs):
    ours = OrderedCountVectorizer(inputCol="features", outputCol="v").fit(docs)
    ml = CountVectorizer(inputCol="features", outputCol="v").fit(docs)
    assert set(ours.vocabulary) == set(ml.vocabulary)
    a = {r.id: dict(zip([ours.vocabulary[i] for i in r.v.indices], r.v.values)) for r in ours.transform(docs).collect()}
    b = {r.id: dict(zip([ml.vocabulary[i] for i in r.v.indices], r.v.values)) for r in ml.transform(docs).collect()}
    assert a == b
    with pytest.raises(ValueError, match="empty vocabulary"):
        OrderedCountVectorizer(inputCol="features", outputCol="v", minDF=10).fit(docs)


def test_term_counts_equal_vectors(docs):
    vocab = build_vocabulary(docs, min_df=2)
    long = {(r.id, r.term): r.cnt for r in term_counts(docs, vocab).collect()}
    model = OrderedCountVectorizer(inputCol="features", outputCol="v", minDF=2).fit(docs)
    vec = {}
    for r in model.transform(docs).collect():
        for i, v in zip(r.v.indices, r.v.values):
            vec[(r.id, model.vocabulary[i])] = int(v)
    assert long == vec


def test_idf_golden(spark, docs):
    w = {r.term: r.idf for r in idf_weights(build_vocabulary(docs), 3).collect()}
    assert w["a"] == pytest.approx(0.693147, abs=1e-6) and w["d"] == pytest.approx(0.693147, abs=1e-6)
    assert w["b"] == pytest.approx(0.287682, abs=1e-6) and w["c"] == pytest.approx(0.287682, abs=1e-6)
    # equal to pyspark.ml IDF on the vectors
    cv = OrderedCountVectorizer(inputCol="features", outputCol="v").fit(docs)
    m = IDF(inputCol="v", outputCol="w").fit(cv.transform(docs))
    assert [round(x, 9) for x in m.idf] == [round(w[t], 9) for t in cv.vocabulary]
    long = {(r.id, r.term): r.tfidf for r in tfidf(term_counts(docs), idf_weights(build_vocabulary(docs), 3)).collect()}
    assert long[(0, "a")] == pytest.approx(2 * math.log(2))


def test_feature_pipeline(docs):
    root = FeaturePipeline()
    assert root.is_root and root.fit(docs) is docs and root.transform(docs) is docs
    p = FeaturePipeline().add(NGram(n=2)).add(OrderedCountVectorizer()).add(IDF())
    out = p.fit(docs.withColumn("extra", F.lit(1)))
    assert out.columns == ["id", "extra", "features"]
    assert dict(out.dtypes)["features"] == "vector"
    assert p.model is not None and len(p.model.stages) == 3
    test = p.transform(docs.withColumn("extra", F.lit(2)))
    assert test.columns == ["id", "extra", "features"]
    with pytest.raises(RuntimeError):
        FeaturePipeline().add(OrderedCountVectorizer()).transform(docs)


def test_label_dictionary_ties_alphabetical(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3, 3, 1, 2, 2, 1])], "id long, label long")
    d = label_dictionary(df).orderBy("ix").collect()
    assert [r.label for r in d] == ["1", "2", "3"]
    assert label_indexer().fit(df).labels == ["1", "2", "3"]


def test_index_labels_equals_string_indexer_skip(spark):
    train = spark.createDataFrame([(0, 3), (1, 3), (2, 1), (3, None)], "id long, label long")
    test = spark.createDataFrame([(10, 3), (11, 9), (12, None), (13, 1)], "id long, label long")
    ml = StringIndexer(inputCol="label", outputCol="indexedLabel", handleInvalid="skip").fit(train)
    a = sorted(map(tuple, ml.transform(test).collect()))
    b = sorted(map(tuple, index_labels(test, label_dictionary(train)).select("id", "label", "indexedLabel").collect()))
    assert a == b == [(10, 3, 0.0), (13, 1, 1.0)]


def test_vector_counts_equal_token_counts(spark, docs):
    model = OrderedCountVectorizer(inputCol="features", outputCol="v", minDF=2).fit(docs)
    long = vector_counts(model.transform(docs), model.vocabulary, "v")
    assert dict(long.dtypes) == {"id": "bigint", "term": "string", "cnt": "bigint"}
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, term_counts(docs, build_vocabulary(docs, min_df=2)).collect()))
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()


def test_global_rank_matches_sort(spark):
    import random
    from corpusml.operators.ranking import global_rank
    rng = random.Random(5)
    rows = [(f"t{i:05d}", rng.randrange(20)) for i in range(3000)]
    df = spark.createDataFrame(rows, "term string, tf long")
    order = [F.col("tf").desc(), F.col("term").asc()]
    want = [t for t, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    for parts in (1, 7):
        with global_rank(df, order, "ix", num_partitions=parts) as ranked:
            got = ranked.collect()
        assert [r.term for r in sorted(got, key=lambda r: r.ix)] == want
        assert sorted(r.ix for r in got) == list(range(3000))
    with global_rank(df, order, "ix", limit=100) as ranked:
        top = ranked.collect()
    assert sorted(r.term for r in top) == sorted(want[:100])


def test_vocabulary_leaves_nothing_behind(spark, docs):
    import glob

    from corpusml.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    vocab = build_vocabulary(docs)
    assert [r.ix for r in vocab.orderBy("ix").collect()] == [0, 1, 2, 3]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert not glob.glob(f"{folder}/corpusml-rank-*")


def test_filtered_stats_have_no_cap(docs):
    assert sorted(r.term for r in filtered_stats(docs).collect()) == ["a", "b", "c", "d"]
    assert sorted(r.term for r in filtered_stats(docs, min_df=2).collect()) == ["b", "c"]
