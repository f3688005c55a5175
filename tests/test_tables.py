"""Models and vocabularies as tables: matching, sparse scoring, splits, trees."""

import time
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusml.functions.tokens import asm_tokens
from corpusml.operators.bayes import nb_parameters, sparse_scores
from corpusml.operators.forest import forest_nodes, forest_votes, random_forest
from corpusml.operators.labels import index_labels, label_dictionary
from corpusml.operators.matching import match_vocabulary
from corpusml.operators.splits import root_splits
from corpusml.operators.vocabulary import term_counts
from corpusml.operators.weighting import idf_weights, tfidf
from corpusml.plans.jobs import fit_naive_bayes

TEXTS = [None, "", "mov", ".text:00401000 mov eax, w7\n.text:00401010 w99999 w100000 mov",
         ".rsrc:00500000 W7 w7x w7", "mov " * 500, "é w1 éw1 w1é", "no such thing"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_vocabulary_table_of_100000_words(spark, broadcast):
    """Equal to the list in the plan, and no word is in the plan."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    words = spark.range(100_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    words = words.unionByName(spark.createDataFrame([("mov",), ("mov",)], "word string"))
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t0 = time.perf_counter()
        found = match_vocabulary(docs, words)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert time.perf_counter() - t0 < 10 and len(plan) < 30_000 and "w99999" not in plan
        got = {r["id"]: r["features"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    small = ["mov"] + [f"w{i}" for i in (1, 7, 99999)]
    want = {r["id"]: r["f"] or [] for r in docs.select("id", asm_tokens("text", small).alias("f")).collect()}
    assert got == want


def test_vocabulary_table_of_any_size_gathers_rows_of_one_id(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 5 or None, t) for i, t in enumerate(TEXTS)], "id long, text string")
    words = spark.createDataFrame([("mov",), (None,), ("w7",)], "word string")
    small = {r["id"]: r["features"] for r in match_vocabulary(docs, words).collect()}
    monkeypatch.setattr("corpusml.operators.matching.BROADCAST_BYTES", -1)
    assert small == {r["id"]: r["features"] for r in match_vocabulary(docs, words).collect()} and len(small) == 5


def test_vocabulary_table_without_words_or_documents(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    none = spark.createDataFrame([], "word string")
    assert {r["id"]: r["features"] for r in match_vocabulary(docs, none).collect()} == {
        i: [".text:", ".text:"] if i == 3 else [".rsrc:"] if i == 4 else [] for i in range(len(TEXTS))}
    assert match_vocabulary(docs.where("false"), none).collect() == []


def labelled(spark):
    rows = [(i, c, [f"t{(i * k) % 13}" for k in range(1, 3 + i % 7)] + [c]) for i in range(120) for c in "abc"[i % 3]]
    return spark.createDataFrame(rows, "id long, label string, features array<string>")


def test_sparse_scores_equal_the_ml_model(spark):
    train = labelled(spark).where("id % 4 <> 0")
    test = labelled(spark).where("id % 4 = 0").select("id", "features").unionByName(spark.createDataFrame(
        [(1000, []), (1001, ["never seen"]), (1002, ["t1"] * 400), (1003, ["", "t2"])], "id long, features array<string>"))
    fitted = fit_naive_bayes(train)
    want = {r["id"]: (r["prediction"], r["rawPrediction"]) for r in fitted.score(test, labelled=False).collect()}
    classes, theta = nb_parameters(index_labels(train, label_dictionary(train), "label"))
    rows = sparse_scores(test, classes, theta).collect()
    assert {r["id"]: r["prediction"] for r in rows} == {i: p for i, (p, _) in want.items()}
    for r in rows:
        assert [r["scores"][c] for c in sorted(r["scores"])] == pytest.approx(list(want[r["id"]][1]), rel=1e-9)


def test_sparse_scoring_has_no_vector_of_the_vocabulary(spark):
    """2**18 terms: planned in under 5 seconds, none of them in the plan."""
    n = 1 << 18
    terms = spark.range(n).select(F.concat(F.lit("z"), F.col("id").cast("string")).alias("term"))
    theta = terms.crossJoin(spark.createDataFrame([(0.0,), (1.0,)], "ix double")).withColumn("theta", F.lit(-3.0))
    classes = spark.createDataFrame([(0.0, -0.5, -9.0), (1.0, -0.9, -9.0)], "ix double, pi double, unseen_theta double")
    docs = spark.createDataFrame([(1, ["z5", "z262143", "no"])], "id long, features array<string>")
    t0 = time.perf_counter()
    scored = sparse_scores(docs, classes, theta)
    weighted = tfidf(term_counts(docs, terms), idf_weights(terms.withColumn("df", F.lit(1)), 9))
    for df in (scored, weighted):
        assert "z262143" not in df._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - t0 < 5
    assert scored.first()["scores"] == {0.0: pytest.approx(-6.5), 1.0: pytest.approx(-6.9)}
    assert sorted(r["term"] for r in weighted.collect()) == ["z262143", "z5"]


def test_root_splits_by_brute_force(spark):
    rows = [(i, f"f{k}", (i * (k + 2)) % 9) for i in range(90) for k in range(5)]
    counts = spark.createDataFrame([r for r in rows if r[2]], "id long, term string, cnt long")
    labels = [(i, float((i * i) % 3 == 1) + float(i > 60)) for i in range(90)]
    got = {r["term"]: (r["threshold"], r["n_left"], r["gain"]) for r in root_splits(
        counts, spark.createDataFrame(labels, "id long, ix double"), max_bins=64).collect()}

    def gini(part):
        return 1 - sum((n / len(part)) ** 2 for n in Counter(part).values()) if part else 0

    of = dict(labels)
    for k in range(5):
        values = {i: v for i, f, v in rows if f == f"f{k}"}
        best = None
        for t in sorted(set(values.values()))[:-1]:
            left, right = ([of[i] for i, v in values.items() if (v <= t) == side] for side in (True, False))
            gain = gini(list(of.values())) - len(left) / 90 * gini(left) - len(right) / 90 * gini(right)
            if best is None or gain > best[2] + 1e-9:
                best = (t, len(left), gain)
        assert got[f"f{k}"] == pytest.approx(best, abs=1e-8)


def test_root_splits_in_few_bins(spark):
    """Thresholds are bin ends; a feature with one value has no split."""
    counts = spark.createDataFrame([(i, "many", i) for i in range(1, 100)] + [(i, "one", 4) for i in range(100)],
                                   "id long, term string, cnt long")
    labels = spark.range(100).select("id", (F.col("id") >= 37).cast("double").alias("ix"))
    [r] = root_splits(counts, labels, max_bins=4).collect()
    assert (r["term"], r["threshold"], r["n_left"]) == ("many", 49, 50)


def test_root_splits_of_many_rows(spark):
    """Class totals whose squares pass 32 bits."""
    labels = spark.range(120_000).select("id", (F.col("id") >= 60_000).cast("double").alias("ix"))
    counts = labels.where("ix = 1").select("id", F.lit("t").alias("term"), F.lit(3).cast("long").alias("cnt"))
    [r] = root_splits(counts, labels).collect()
    assert (r["term"], r["threshold"], r["n_left"], r["gain"]) == ("t", 0, 60_000, pytest.approx(0.5))


def test_forest_walk_equals_the_model(spark):
    """The fitted trees as a node table, walked by joins, on every row."""
    docs = labelled(spark)
    vectors = CountVectorizerModel.from_vocabulary([f"t{k}" for k in range(13)], "features", "tokenCounts").transform(docs)
    data = index_labels(vectors, label_dictionary(docs), "label")
    model = random_forest(num_trees=7, max_depth=6, seed=3).fit(data)
    nodes = forest_nodes(spark, model)
    walked = {r["id"]: r for r in forest_votes(data, nodes, "tokenCounts").collect()}
    scored = model.transform(data).select("id", "prediction", vector_to_array("rawPrediction").alias("raw")).collect()
    assert len(walked) == len(scored) == 120
    for r in scored:
        assert walked[r["id"]]["prediction"] == r["prediction"]
        assert walked[r["id"]]["votes"] == pytest.approx(r["raw"], abs=1e-9)
