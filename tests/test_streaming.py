"""A fitted classifier scores a file stream like the batch job."""

import os

from conftest import make_dataset, write
from corpusml.plans.jobs import fit_naive_bayes
from corpusml.sources import load_corpus, read_documents, read_manifest, tokenize
from corpusml.streaming import document_stream, score_stream


def test_stream_scores_like_batch(spark, scratch):
    docs = {}
    for i in range(12):
        body = " ".join(["AA BB"] * 4 if i % 2 == 0 else ["CC DD"] * 4)
        docs[f"d{i:02d}"] = (f"00401000 {body}\n", "")
    root = make_dataset(f"{scratch}/data", docs)
    write(f"{scratch}/x", "".join(f"d{i:02d}\n" for i in range(12)))
    write(f"{scratch}/y", "".join(f"{1 + i % 2}\n" for i in range(12)))
    train = load_corpus(spark, f"{scratch}/x", f"{scratch}/y", root, "bytes")
    fitted = fit_naive_bayes(train)
    batch = {r.hash: r.predictedClass for r in fitted.score(
        read_documents(spark, read_manifest(spark, f"{scratch}/x"), root, "bytes")
        .select("hash", tokenize("text", "bytes").alias("features")), labelled=False).collect()}
    q = (score_stream(fitted, document_stream(spark, root, "bytes", max_files_per_trigger=5))
         .writeStream.format("memory").queryName("scored").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.hash: r.predictedClass for r in spark.sql("SELECT * FROM scored").collect()}
    assert got == batch and len(got) == 12
