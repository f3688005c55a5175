"""Physical-plan properties of the registered queries (sf0.001), in the
layout of the driver's table, and on one thread without broadcast joins."""

import pytest

from conftest import SF0001
from corpusml.plans import queries as Q
from corpusml.plans import tables as tb

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df) -> tuple[str, list[set[str]]]:
    plan = df._jdf.queryExecution().executedPlan()
    return plan.toString(), exchanged(plan)


@pytest.fixture(scope="module", params=["as it is", "unsplit, no broadcast"])
def plans(request, spark):
    patch = pytest.MonkeyPatch()
    if request.param != "as it is":
        patch.setattr(tb, "split_scan", lambda df, key: df)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {name: plan_of(q(spark, SF0001)) for name, q in Q.queries().items()}
    finally:
        patch.undo()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_or_cross_products(plans):
    for name, (plan, _) in plans.items():
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


def test_scan_reads_only_needed_columns(plans):
    # label-only work must not read the document texts
    for name in ("label_index", "label_decode", "unseen_label_skip", "unseen_class_skip", "rf_label_index"):
        scans = [line for line in plans[name][0].splitlines() if "FileScan parquet" in line]
        assert scans and all("text:" not in s for s in scans), name


def test_token_counts_aggregate_map_side(plans):
    for name in ("byte_token_counts", "asm_token_counts", "ngram_counts", "lowercase_effect"):
        assert "partial_count" in plans[name][0], name


def exchanged(node) -> list[set[str]]:
    """Names of the columns that each exchange of a plan moves."""
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.initialPlan()
    own = [{node.output().apply(i).name() for i in range(node.output().size())}] if node.nodeName() == "Exchange" else []
    children = node.children()
    return own + [x for i in range(children.size()) for x in exchanged(children.apply(i))]


def test_no_text_or_token_list_is_shuffled(plans):
    for name, (_, moved) in plans.items():
        if name not in ("line_index", "token_preview"):  # their results are texts: lines, 20 documents
            assert all(not columns & {"text", "features", "tokens"} for columns in moved), (name, moved)


def test_scoring_adds_no_shuffle(plans):
    """Vectorizing and scoring are per-row with the models' parameters."""
    for name in ("nb_predict", "nb_predict_tfidf", "nb_predict_bigrams", "nb_predict_asm", "rf_predict", "term_counts",
                 "tfidf", "rf_features"):
        assert "Exchange hashpartitioning" not in plans[name][0], name
        assert "Join" not in plans[name][0], name
