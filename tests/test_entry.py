"""Driver contract: entry smoke test, registry, oracle agreement at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from corpusml.plans import oracle, queries
from scripts.check_oracle import digest


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "prediction", "predictedClass"]
    assert len(rows) > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(queries.queries()) - set(oracle.oracle_sql()) == {"rf_predict", "rf_accuracy"}
    assert set(queries.queries()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    sdf = queries.queries()[name](spark, SF0001)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(oracle.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows) == digest(dcols, drows)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached  # nothing stays cached
