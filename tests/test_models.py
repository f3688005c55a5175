"""Naive Bayes, random forest, scores and the end-to-end jobs."""

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF001, make_dataset, write
from corpusml.operators import (
    accuracy, build_vocabulary, index_labels, label_dictionary, label_indexer, layout_partitions, nb_parameters, predictions,
)
from corpusml.plans import tables as tb
from corpusml.plans.jobs import fit_naive_bayes, fit_random_forest, nb_job, rf_job
from corpusml.sources import ingest_documents, labelled_manifest


@pytest.fixture(scope="module")
def corpus(spark):
    c = tb.corpus(spark, SF001, "bytes").cache()
    yield c
    c.unpersist()


@pytest.mark.parametrize("listed", [True, False])
def test_nb_parameters_equal_ml_model(spark, corpus, listed):
    train, _ = tb.split(corpus)
    fitted = fit_naive_bayes(train)
    model = fitted.model
    vocab = fitted.features.model.stages[-1].vocabulary
    d = label_dictionary(train)
    labelled = index_labels(train, d)
    vocabulary = build_vocabulary(train) if listed else None
    classes, theta = nb_parameters(labelled, len(vocab), vocabulary)
    pi = {int(r.ix): r.pi for r in classes.collect()}
    unseen = {int(r.ix): r.unseen_theta for r in classes.collect()}
    for c, p in pi.items():
        assert p == pytest.approx(model.pi[c], abs=1e-9)
    th = model.theta.toArray()
    seen = set()
    for r in theta.collect():
        j = vocab.index(r.term)
        assert r.theta == pytest.approx(th[int(r.ix), j], abs=1e-9)
        seen.add((int(r.ix), j))
    for c in range(th.shape[0]):
        for j in range(th.shape[1]):
            if (c, j) not in seen:
                assert th[c, j] == pytest.approx(unseen[c], abs=1e-9)


def test_accuracy_equals_evaluator(spark, corpus):
    train, test = tb.split(corpus)
    scored = fit_naive_bayes(train, idf=True).score(test)
    ev = MulticlassClassificationEvaluator(labelCol="indexedLabel", predictionCol="prediction",
                                           metricName="accuracy").evaluate(scored)
    a1 = accuracy(scored, "indexedLabel", "prediction").first()[0]
    a2 = accuracy(scored, "label", "predictedClass").first()[0]
    assert a1 == pytest.approx(ev) and a2 == pytest.approx(ev)
    assert 0.0 <= ev <= 1.0


def test_predictions_sink(spark, corpus):
    train, test = tb.split(corpus)
    out = predictions(fit_naive_bayes(train).score(test.drop("label")), "id", "predictedClass")
    rows = out.collect()
    assert [r.id for r in rows] == sorted(r.id for r in rows)
    assert out.columns == ["id", "predictedClass"]


def test_forest_reproducible_across_layouts(spark):
    c = tb.corpus(spark, SF001, "joint")
    train, test = tb.split(c)
    runs = []
    for parts in (1, 3, 7):
        layout = train.repartition(parts).cache()
        fitted = fit_random_forest(layout, num_partitions=4)
        runs.append(sorted((r.id, r.prediction) for r in fitted.score(test).select("id", "prediction").collect()))
        layout.unpersist()
    assert runs[0] == runs[1] == runs[2]


def test_forest_layout_follows_the_rows(spark):
    """The number of partitions is the data's, not the session's."""
    train, test = tb.split(tb.corpus(spark, SF001, "asm"))
    layouts = []
    for partitions in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            fitted = fit_random_forest(train, num_trees=3, max_depth=3)
            layouts.append((fitted.extra, sorted(map(tuple, fitted.score(test).select("id", "prediction").collect()))))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert layouts[0] == layouts[1] and layouts[0][0] == {"layout_partitions": 1}


def test_forest_layout_is_bounded_in_the_rows():
    """partitions x nodes are shuffled, so many rows make large partitions, not many."""
    assert [layout_partitions(n) for n in (0, 1, 1000, 1001, 8000, 32_000)] == [1, 1, 1, 2, 8, 32]
    assert layout_partitions(205_000) == layout_partitions(1_600_000) == 32 and layout_partitions(2_400_000) == 48
    assert layout_partitions(24_000_000) == 10 * layout_partitions(2_400_000)


@pytest.fixture()
def files(scratch):
    """A tiny two-class corpus on disk."""
    docs, train, test = {}, [], []
    for i in range(24):
        cls = i % 2
        body = " ".join(["AA BB"] * (3 + i % 4) if cls == 0 else ["CC DD"] * (3 + i % 4))
        asm = "\n".join([".text:00401000 push ebp", ".text:00401010 mov eax, 1"] if cls == 0
                        else [".data:00402000 call x", ".data:00402010 call y", ".data:00402020 lea a"])
        docs[f"h{i:02d}"] = (f"00401000 {body}\n00401010 {body}\n", asm)
        (test if i % 4 == 0 else train).append((f"h{i:02d}", cls + 1))
    root = make_dataset(f"{scratch}/data", docs)
    write(f"{scratch}/train_x", "".join(h + "\n" for h, _ in train))
    write(f"{scratch}/train_y", "".join(f"{y}\n" for _, y in train))
    write(f"{scratch}/test_x", "".join(h + "\n" for h, _ in test))
    write(f"{scratch}/test_y", "".join(f"{y}\n" for _, y in test))
    return scratch, root, [y for _, y in test]


def test_nb_job_end_to_end(spark, files):
    scratch, root, truth = files
    acc = nb_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", f"{scratch}/test_y",
                 base=root)
    assert acc.columns == ["accuracy"] and acc.first()[0] == pytest.approx(1.0)
    pred = nb_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", base=root,
                  idf=True, ngram=2)
    assert [r.predictedClass for r in pred.collect()] == truth
    asm = nb_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", base=root, kind="asm")
    assert [r.predictedClass for r in asm.collect()] == truth


def test_rf_job_end_to_end(spark, files):
    scratch, root, truth = files
    acc = rf_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", f"{scratch}/test_y",
                 base=root, min_df=2)
    assert 0.0 <= acc.first()[0] <= 1.0
    pred = rf_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", base=root, min_df=2)
    assert pred.columns == ["id", "predictedClass"] and pred.count() == len(truth)
    ingest_documents(spark, root, f"{scratch}/table")
    again = rf_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", base=root, min_df=2,
                   table=f"{scratch}/table")
    assert again.collect() == pred.collect()


def test_label_fit_opens_no_document(spark, files):
    """The label index comes from the labelled manifest alone."""
    scratch, root, _ = files
    thin = labelled_manifest(spark, f"{scratch}/train_x", f"{scratch}/train_y")
    plan = label_indexer("label").fit(thin).transform(thin)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and ".bytes" not in plan


def test_unseen_test_label_is_skipped(spark, files):
    scratch, root, truth = files
    write(f"{scratch}/test_y9", "".join(("9" if i == 0 else str(y)) + "\n" for i, y in enumerate(truth)))
    acc = nb_job(spark, f"{scratch}/train_x", f"{scratch}/train_y", f"{scratch}/test_x", f"{scratch}/test_y9",
                 base=root)
    assert acc.first()[0] == pytest.approx(1.0)  # the row labelled 9 left the denominator


def test_write_predictions_in_id_order(spark, corpus, scratch):
    from corpusml.operators import write_predictions
    import glob
    train, test = tb.split(corpus)
    scored = fit_naive_bayes(train).score(test.drop("label")).repartition(5)
    write_predictions(scored, f"{scratch}/pred")
    lines = []
    for part in sorted(glob.glob(f"{scratch}/pred/part-*")):
        lines += open(part).read().splitlines()
    want = [r.predictedClass for r in scored.orderBy("id").collect()]
    assert lines == want


def test_naive_bayes_independent_of_layout(spark, corpus):
    train, test = tb.split(corpus)
    outs = []
    for parts in (1, 5):
        fitted = fit_naive_bayes(train.repartition(parts), idf=True)
        outs.append(sorted((r.id, r.predictedClass) for r in fitted.score(test.drop("label")).collect()))
    assert outs[0] == outs[1]
