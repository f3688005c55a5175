"""Registered queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables (model fitting, where a query needs it, runs when the query is
built; the returned plan is lazy).  The DuckDB form of each one lives in
``corpusml.plans.oracle``; column names and types match it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import IDF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.functions.batches import document_words, dumped_texts
from corpusml.functions.tokens import add_ngrams, byte_tokens, explode_tokens, parse_int
from corpusml.functions.views import asm_listing, hex_dump
from corpusml.operators.bayes import nb_parameters, sparse_scores
from corpusml.operators.evaluate import accuracy, predictions, preview, write_predictions
from corpusml.operators.labels import index_labels, label_decoder, label_dictionary, label_indexer
from corpusml.operators.matching import match_vocabulary
from corpusml.operators.restrict import likely_listed
from corpusml.operators.splits import root_splits
from corpusml.operators.vocabulary import (
    OrderedCountVectorizer, build_vocabulary, filtered_stats, term_counts, vector_counts,
)
from corpusml.operators.weighting import idf_weights, tfidf
from corpusml.plans import tables as tb
from corpusml.plans.jobs import fit_naive_bayes, fit_random_forest, nb_job
from corpusml.session import scratch_dir, written
from corpusml.sources.buckets import bucketed_joint_corpus, write_buckets
from corpusml.sources.corpus import document_url as url_of
from corpusml.sources.corpus import labelled_manifest, read_manifest
from corpusml.sources.files import write_documents
from corpusml.sources.lines import explode_lines, read_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the registered queries.
URL_BASE = "hdfs://corpus/data"
VOCAB_MIN_DF = 2
VOCAB_TOP_K = 1000
RF_MIN_DF = COUNT_MIN_DF = 10
ROUND = 6


def query(fn: Query | None = None, *, name: str | None = None):
    """Register ``fn`` under ``name`` (default: its own name)."""
    def register(f: Query) -> Query:
        REGISTRY[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


def _r(c, digits: int = ROUND):
    return F.round(c, digits)


def _token_counts(corpus: DataFrame) -> DataFrame:
    return (explode_tokens(corpus, "features", "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))


# ---- sources ---------------------------------------------------------------

@query
def line_index(spark, sf_dir):
    """0-based line numbers of every document text."""
    return explode_lines(tb.documents(spark, sf_dir), "text", ["doc_id"])


def _files(spark) -> str:
    """A fresh folder for text files, shared by all executors and deleted
    when the application ends."""
    return f"{scratch_dir(spark, 'files')}/lines"


@query
def global_line_index(spark, sf_dir):
    """All lines of all documents, written as text files in order and
    numbered across files and splits by the line reader."""
    folder = _files(spark)
    lines = explode_lines(tb.documents(spark, sf_dir), "text", ["doc_id"])
    lines.orderBy("doc_id", "line_no").select(F.col("line").alias("value")).write.text(folder)
    return read_lines(spark, folder)


@query
def manifest_scan(spark, sf_dir):
    """A manifest and a label file, read back and joined by line."""
    folder = _files(spark)
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"), "n_chars")
    docs.orderBy("doc_id").select("hash").write.text(f"{folder}/x")
    docs.orderBy("doc_id").select(F.concat(F.col("n_chars").cast("string"), F.lit(" "))).write.text(f"{folder}/y")
    return labelled_manifest(spark, f"{folder}/x", f"{folder}/y")


@query
def document_url(spark, sf_dir):
    """H1/H2: ``{base}/{kind}/{hash}.{kind}`` with a content hash."""
    d = tb.table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"))
    return d.select("doc_id", "hash", url_of("hash", URL_BASE, "bytes").alias("url"))


@query
def int_parse(spark, sf_dir):
    """A2/H9: labels rendered as padded text lines, parsed back."""
    lab = tb.table(spark, sf_dir, "labels")
    line = F.concat(F.lit(" "), (F.col("quality") * 2 + F.col("toxic")).cast("string"), F.lit("\t"))
    return lab.select("doc_id", parse_int(line).alias("label"))


@query
def labelled_corpus(spark, sf_dir):
    """Byte-token corpus joined with the label table.  Only
    documents that a filter of the labelled ids lets pass are tokenized, next
    to the scan: ``(id, count)`` meets the labels, whatever join Spark picks."""
    lab = tb.table(spark, sf_dir, "labels")
    docs = likely_listed(tb.documents(spark, sf_dir), lab.select("doc_id"), "doc_id")
    counts = tb.corpus(spark, sf_dir, "bytes", docs=docs).select("id", F.size("features").cast("bigint").alias("n_tokens"))
    lab = lab.withColumnRenamed("doc_id", "id")
    return counts.join(lab, "id").select("id", "n_tokens", "quality", "toxic")


@query
def manifest_restrict(spark, sf_dir):
    """Only the documents listed by a manifest (here: the label table)."""
    docs = tb.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.md5("text").alias("hash"), "n_chars")
    listed = tb.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return docs.join(listed, "id", "left_semi")


@query
def manifest_filter(spark, sf_dir):
    """The same restriction by a manifest of any size: bitmaps of its
    hashes are broadcast, texts that they let pass are counted beside the
    scan, and a join of thin rows removes false positives."""
    of_id = F.md5(F.col("doc_id").cast("string")).alias("hash")
    docs = tb.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), of_id, "text")
    listed = tb.table(spark, sf_dir, "labels").select(of_id)
    counted = likely_listed(docs, listed, "hash").select(
        "id", "hash", F.size(byte_tokens(hex_dump("text"))).cast("bigint").alias("n_tokens"))
    return counted.join(listed.hint("merge"), "hash", "left_semi").select("id", "hash", "n_tokens")


@query
def corpus_union(spark, sf_dir):
    """G1: two corpora as one (bag union by name)."""
    docs = tb.documents(spark, sf_dir).select(F.lit("documents").alias("corpus"),
                                              F.col("doc_id").alias("id"), "text")
    bench = tb.table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("corpus"),
                                                        F.col("item_id").alias("id"), "text")
    both = docs.unionByName(bench)
    return both.select("corpus", "id", F.size(byte_tokens(hex_dump("text"))).cast("bigint").alias("n_tokens"))


# ---- tokenizers ------------------------------------------------------------

@query
def byte_token_counts(spark, sf_dir):
    """A4/H3: byte tokens of the hex-dump view."""
    return _token_counts(tb.corpus(spark, sf_dir, "bytes"))


@query
def asm_token_counts(spark, sf_dir):
    """Segment titles and mnemonics of the listing view."""
    return _token_counts(tb.corpus(spark, sf_dir, "asm"))


@query
def joint_token_counts(spark, sf_dir):
    """Joint tokens of hex dump + blank line + listing."""
    return _token_counts(tb.corpus(spark, sf_dir, "joint"))


BUCKET_CHARS = 32 << 20


@query
def joint_corpus_buckets(spark, sf_dir):
    """Both views of the documents as tables bucketed by hash,
    joined in place: joint tokens in order, of every line of a manifest."""
    thin = tb.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.md5(F.col("doc_id").cast("string")).alias("hash"), "n_chars")
    chars = thin.agg(F.sum("n_chars")).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-int(chars) // BUCKET_CHARS))
    folder = scratch_dir(spark, "buckets")
    name = "documents_" + folder[-32:]
    docs = tb.documents(spark, sf_dir).withColumn("hash", F.md5(F.col("doc_id").cast("string")))
    views = {"bytes": dumped_texts(docs.select("hash", "text")), "asm": docs.select("hash", asm_listing("text").alias("text"))}
    for kind, view in views.items():
        write_buckets(view, f"{name}_{kind}", f"{folder}/{kind}", buckets)
    found = bucketed_joint_corpus(spark, thin.drop("n_chars"), name, buckets, tb.LISTING_WORDS)
    return found.select("id", F.size("features").cast("bigint").alias("n_tokens"),
                        F.md5(F.array_join("features", " ")).alias("tokens_md5"))


@query
def lowercase_effect(spark, sf_dir):
    """H6: the three tokenizers on lower-cased text."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), tb.token_column(k, lowercase=True).alias("tokens"))
                      for k in ("bytes", "asm", "joint")])
    views = tb.documents(spark, sf_dir).select(F.explode(kinds).alias("v"))
    return (explode_tokens(views, "v.tokens", "token", keep=(F.col("v.kind").alias("kind"),))
            .groupBy("kind", "token").agg(F.count(F.lit(1)).alias("cnt")))


@query
def ngram_counts(spark, sf_dir):
    """H7: 1-, 2- and 3-grams of byte tokens."""
    c = tb.corpus(spark, sf_dir, "bytes")
    c = add_ngrams(add_ngrams(c, 2, "features", "g2"), 3, "features", "g3")
    grams = c.select(F.explode(F.array(*[
        F.struct(F.lit(n).cast("bigint").alias("n"), F.col(g).alias("g"))
        for n, g in ((1, "features"), (2, "g2"), (3, "g3"))])).alias("s"))
    return (explode_tokens(grams, "s.g", "gram", keep=(F.col("s.n").alias("n"),))
            .groupBy("n", "gram").agg(F.count(F.lit(1)).alias("cnt")))


WORD_MIN_DOCS = 2


def _word_table(spark, sf_dir):
    """``[word]``: words of the texts (not starting with a digit) in at
    least ``WORD_MIN_DOCS`` documents: a vocabulary that grows with the data."""
    own = document_words(tb.documents(spark, sf_dir)).where(F.col("word").rlike("^[A-Za-z_]"))
    return own.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= WORD_MIN_DOCS).select("word")


@query
def asm_vocabulary_table(spark, sf_dir):
    """The listing's tokens under a vocabulary that is a table."""
    docs = tb.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), asm_listing("text").alias("text"))
    found = match_vocabulary(docs, _word_table(spark, sf_dir))
    return found.select("id", F.size("features").cast("bigint").alias("n_tokens"),
                        F.md5(F.array_join("features", " ")).alias("tokens_md5"))


# ---- vocabulary, vectors, weights ------------------------------------------

def _train(spark, sf_dir, kind="bytes"):
    return tb.split(tb.corpus(spark, sf_dir, kind))[0]


@query
def vocabulary_topk(spark, sf_dir):
    """Top-k byte bigrams of the training split with minDF."""
    train = tb.token_lists(spark, sf_dir, part="train", ngram=2)
    v = build_vocabulary(train, min_df=VOCAB_MIN_DF, vocab_size=VOCAB_TOP_K)
    return v.select(F.col("ix").cast("bigint").alias("ix"), "term", "tf", "df")


def _vectors(spark, sf_dir, kind="bytes"):
    """Count vectors of every document (train and test) under the training
    vocabulary with minDF, and the fitted model: other tokens drop out."""
    both = tb.token_lists(spark, sf_dir, kind)
    train = tb.token_lists(spark, sf_dir, kind, "train")
    model = OrderedCountVectorizer(inputCol="features", outputCol="counts", minDF=COUNT_MIN_DF).fit(train)
    return model.transform(both).select("id", "counts"), model


@query(name="term_counts")
def term_counts_long(spark, sf_dir):
    """Count vectors of all documents in long form."""
    vectors, model = _vectors(spark, sf_dir)
    return vector_counts(vectors, model.vocabulary, "counts")


@query(name="idf_weights")
def idf_weights_q(spark, sf_dir):
    """D3: smoothed idf of all training terms."""
    train = tb.token_lists(spark, sf_dir, part="train")
    n_docs = tb.split(tb.labels_of(spark, sf_dir))[0].count()
    return idf_weights(filtered_stats(train), n_docs).select("term", "df", _r(F.col("idf")).alias("idf"))


@query(name="tfidf")
def tfidf_long(spark, sf_dir):
    """Tf x idf per (document, term) of all documents."""
    vectors, model = _vectors(spark, sf_dir)
    idf = IDF(inputCol="counts", outputCol="weights").fit(tb.split(vectors)[0])
    long = vector_counts(idf.transform(vectors), model.vocabulary, "weights", value_col="w", as_type="double")
    return long.select("id", "term", _r(F.col("w")).alias("tfidf"))


@query
def rf_features(spark, sf_dir):
    """The forest's input, joint token counts with minDF."""
    vectors, model = _vectors(spark, sf_dir, "joint")
    return vector_counts(vectors, model.vocabulary, "counts")


@query
def term_counts_uncapped(spark, sf_dir):
    """The counts of ``term_counts`` for a vocabulary of any size."""
    train = tb.token_lists(spark, sf_dir, part="train")
    return term_counts(tb.token_lists(spark, sf_dir), filtered_stats(train, min_df=COUNT_MIN_DF))


@query
def tfidf_uncapped(spark, sf_dir):
    """The weights of ``tfidf`` for a vocabulary of any size."""
    stats = filtered_stats(tb.token_lists(spark, sf_dir, part="train"), min_df=COUNT_MIN_DF)
    n_docs = tb.split(tb.labels_of(spark, sf_dir))[0].count()
    return tfidf(term_counts(tb.token_lists(spark, sf_dir)), idf_weights(stats, n_docs)).select("id", "term", _r(F.col("tfidf")).alias("tfidf"))


# ---- labels ------------------------------------------------------------------

@query
def label_index(spark, sf_dir):
    """Label dictionary (frequency desc, ties by label)."""
    return label_dictionary(tb.split(tb.labels_of(spark, sf_dir))[0], "label")


@query
def label_decode(spark, sf_dir):
    """Index all labels by the training dictionary, decode them back."""
    both = tb.labels_of(spark, sf_dir)
    ix = label_indexer("label").fit(tb.split(both)[0])
    out = label_decoder(ix.labels, "indexedLabel", "decoded").transform(ix.transform(both))
    return out.select("id", "indexedLabel", "decoded")


@query
def unseen_label_skip(spark, sf_dir):
    """Test rows whose label is null or unseen in training are removed."""
    docs = tb.labels_of(spark, sf_dir).select("id")
    lab = tb.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"),
                                                   F.col("quality").cast("bigint").alias("label"))
    rows = docs.join(lab, "id", "left")
    train, test = tb.split(rows)
    d = label_dictionary(train, "label")
    return index_labels(test, d, "label").select("id", "label", "indexedLabel")


@query
def unseen_class_skip(spark, sf_dir):
    """A class that only the test split has is removed from it."""
    only_test = tb.is_test() & (F.col("id") % 3 == 0)
    rows = tb.labels_of(spark, sf_dir).withColumn("label", F.when(only_test, F.lit("new")).otherwise(F.col("label")))
    train, test = tb.split(rows)
    return index_labels(test, label_dictionary(train, "label"), "label").select("id", "label", "indexedLabel")


@query
def rf_label_index(spark, sf_dir):
    """D4/I6 as the forest job does it: the indexer on all labelled rows."""
    both = tb.labels_of(spark, sf_dir)
    indexed = label_indexer("label").fit(tb.split(both)[0]).transform(both)
    return indexed.groupBy("label", "indexedLabel").agg(F.count(F.lit(1)).alias("n"))


# ---- naive Bayes ---------------------------------------------------------------

def _nb_tables(spark, sf_dir):
    train = _train(spark, sf_dir)
    d = label_dictionary(tb.split(tb.labels_of(spark, sf_dir))[0], "label")
    labelled = index_labels(train, d, "label")
    classes, theta = nb_parameters(labelled)
    return d, classes, theta


@query
def nb_priors(spark, sf_dir):
    """Class priors (with the unseen-term log likelihood per class)."""
    d, classes, _ = _nb_tables(spark, sf_dir)
    return classes.join(d.select(F.col("ix"), "label"), "ix").select(
        "ix", "label", "n_docs", _r(F.col("pi")).alias("pi"),
        _r(F.col("unseen_theta")).alias("unseen_theta"))


@query
def nb_theta(spark, sf_dir):
    """Class-term log likelihoods of observed pairs."""
    _, _, theta = _nb_tables(spark, sf_dir)
    return theta.select("ix", "term", F.col("tf").cast("bigint").alias("tf"),
                        _r(F.col("theta")).alias("theta"))


def _nb_scored(spark, sf_dir, kind="bytes", idf=False, ngram=1, labelled=False):
    train, test = (tb.token_lists(spark, sf_dir, kind, part, ngram) for part in ("train", "test"))
    thin = tb.split(tb.labels_of(spark, sf_dir))[0]
    fitted = fit_naive_bayes(train, idf=idf, labels=thin)
    if not labelled:
        test = test.drop("label")
    return fitted.score(test, labelled=labelled)


def _nb_predictions(scored):
    return scored.select("id", "prediction", "predictedClass")


@query
def nb_predict(spark, sf_dir):
    """Byte unigrams, term counts, multinomial NB."""
    return _nb_predictions(_nb_scored(spark, sf_dir))


@query
def nb_predict_tfidf(spark, sf_dir):
    """I9 with --idf: byte unigrams weighted by idf."""
    return _nb_predictions(_nb_scored(spark, sf_dir, idf=True))


@query
def nb_predict_bigrams(spark, sf_dir):
    """I9 with --ngram 2 --idf: byte bigrams weighted by idf."""
    return _nb_predictions(_nb_scored(spark, sf_dir, idf=True, ngram=2))


@query
def nb_predict_asm(spark, sf_dir):
    """I9 with --asm: segment titles and mnemonics of the listing view."""
    return _nb_predictions(_nb_scored(spark, sf_dir, kind="asm"))


@query
def nb_predict_sparse(spark, sf_dir):
    """The same predictions from sparse tables of the model."""
    d, classes, theta = _nb_tables(spark, sf_dir)
    test = tb.split(tb.corpus(spark, sf_dir, "bytes"))[1]
    labels = [r["label"] for r in d.orderBy("ix").collect()]  # one entry per class
    scored = sparse_scores(test, classes, theta)
    return label_decoder(labels).transform(scored).select("id", "prediction", "predictedClass")


@query
def nb_job_files(spark, sf_dir):
    """A1-A4/I9/S1 on files: documents, manifests and labels are written as
    files (one per document), the job reads them, trains and predicts."""
    base = scratch_dir(spark, "corpus")
    docs = tb.documents(spark, sf_dir).select(F.md5(F.col("doc_id").cast("string")).alias("hash"),
                                              hex_dump("text").alias("text"))
    write_documents(docs, base, "bytes")
    thin = tb.labels_of(spark, sf_dir).withColumn("hash", F.md5(F.col("id").cast("string")))
    names = sorted(r["label"] for r in thin.select("label").distinct().collect())  # one entry per class
    code = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("label")).cast("string")
    for part, rows in zip(("train", "test"), tb.split(thin), strict=True):
        rows.orderBy("id").select("hash").write.text(f"{base}/{part}_x")
        rows.orderBy("id").select(code).write.text(f"{base}/{part}_y")
    found = nb_job(spark, f"{base}/train_x", f"{base}/train_y", f"{base}/test_x", base=base)
    lines = read_manifest(spark, f"{base}/test_x").withColumnRenamed("id", "line")
    named = found.withColumnRenamed("id", "line").join(lines, "line").join(thin.select("id", "hash"), "hash")
    return written(named.select("id", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("predictedClass"))
                                .alias("predictedClass")), "predictions")


@query
def ordered_predictions(spark, sf_dir):
    """Predictions written in id order, read back by line."""
    folder = _files(spark)
    # A sort reads its input twice (range bounds first): it gets written rows.
    scored = written(_nb_predictions(_nb_scored(spark, sf_dir)), "scored")
    write_predictions(predictions(scored), folder)
    return read_lines(spark, folder).select(F.col("id").alias("line"), F.col("line").alias("predictedClass"))


@query
def nb_accuracy(spark, sf_dir):
    """Mean of (label == predictedClass)."""
    return accuracy(_nb_scored(spark, sf_dir, labelled=True), "label", "predictedClass")


@query
def evaluator_accuracy(spark, sf_dir):
    """Evaluator accuracy (prediction vs indexedLabel), bigrams + idf."""
    scored = _nb_scored(spark, sf_dir, idf=True, ngram=2, labelled=True)
    return accuracy(scored, "indexedLabel", "prediction")


@query
def token_preview(spark, sf_dir):
    """First 20 training rows of the joint corpus by id."""
    train = tb.split(tb.labels_of(spark, sf_dir))[0]
    first = preview(train.select("id"), 20)  # only these are read and tokenized
    docs = tb.documents(spark, sf_dir).join(first.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    return tb.corpus(spark, sf_dir, "joint", docs=docs).select(
        "id", F.size("features").cast("bigint").alias("n_tokens"), F.array_join("features", " ").alias("tokens"))


# ---- random forest ------------------------------------------------------------

@query
def rf_root_splits(spark, sf_dir):
    """The best first split of every token of the forest's input."""
    vectors, model = _vectors(spark, sf_dir, "joint")
    counts = vector_counts(tb.split(vectors)[0], model.vocabulary, "counts")
    train = tb.split(tb.labels_of(spark, sf_dir))[0]
    labels = index_labels(train, label_dictionary(train, "label"), "label").select("id", F.col("indexedLabel").alias("ix"))
    best = root_splits(counts, labels)
    return best.select("term", F.col("threshold").cast("bigint").alias("threshold"), "n_left", _r(F.col("gain")).alias("gain"))


def _rf_scored(spark, sf_dir, labelled):
    train, test = tb.split(tb.corpus(spark, sf_dir, "joint"))
    fitted = fit_random_forest(train, min_df=RF_MIN_DF, labels=tb.split(tb.labels_of(spark, sf_dir))[0])
    if not labelled:
        test = test.drop("label")
    return fitted.score(test, labelled=labelled)


@query
def rf_predict(spark, sf_dir):
    """Joint tokens, minDF 10, 20 trees of depth 10."""
    return _rf_scored(spark, sf_dir, False).select("id", "prediction", "predictedClass")


@query
def rf_accuracy(spark, sf_dir):
    """Evaluator accuracy of the forest."""
    return accuracy(_rf_scored(spark, sf_dir, True), "indexedLabel", "prediction")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
