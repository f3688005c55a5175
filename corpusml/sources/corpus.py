"""Corpus loading: manifest + labels + one file per document -> tokens.

Layout on any Hadoop file system: ``{base}/{kind}/{hash}.{kind}`` with
``kind`` in ``bytes`` / ``asm``.  A manifest lists one hash per line; a
label file has one integer per line, aligned with the manifest by line
number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.functions.tokens import (
    asm_tokens, byte_tokens, explode_tokens, joint_tokens, join_token_lists, parse_int, with_line_break,
)
from corpusml.operators.restrict import likely_listed
from corpusml.session import written
from corpusml.sources.files import NAMES_PER_TASK, document_names, file_sizes, glob_escaped, opens_by_name, text_of
from corpusml.sources.lines import read_lines

KINDS = ("bytes", "asm", "joint")
URL_SCHEME = re.compile(r"^[a-zA-Z0-9]+:")


def normalize_base(base, aliases: Mapping[str, str] | None = None) -> str:
    """``base`` as a URL: aliases expanded, ``scheme:`` kept, otherwise an
    absolute ``file:`` path."""
    base = str(base)
    if aliases and base in aliases:
        base = aliases[base]
    if not URL_SCHEME.match(base):
        base = f"file:{Path(base).resolve()}"
    return base.rstrip("/")


def document_url(hash_col, base="./data", kind: str = "bytes",
                 aliases: Mapping[str, str] | None = None) -> Column:
    """``{base}/{kind}/{hash}.{kind}`` as a column expression."""
    h = F.col(hash_col) if isinstance(hash_col, str) else hash_col
    return F.concat(F.lit(f"{normalize_base(base, aliases)}/{kind}/"), h, F.lit(f".{kind}"))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """``DataFrame[id bigint, hash string]``; duplicates stay separate rows."""
    return read_lines(spark, path).select("id", F.col("line").alias("hash"))


def read_labels(spark: SparkSession, path) -> DataFrame:
    """``DataFrame[id bigint, label bigint]``; a malformed line fails the job."""
    return read_lines(spark, path).select("id", parse_int("line").alias("label"))


def scan_documents(spark: SparkSession, base, kind: str) -> DataFrame:
    """``[hash, text]`` of every non-empty ``{base}/{kind}/{hash}.{kind}``.

    A plan that needs no text reads none: content is a column of its own and
    is pruned like any other.  File names are taken as they are (blanks,
    ``%`` and glob characters have no meaning)."""
    base = normalize_base(base)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{kind}")
             .load(glob_escaped(f"{base}/{kind}")))
    return files.select(F.regexp_extract("path", rf"(?s)([^/]*)\.{kind}$", 1).alias("hash"),
                        F.col("content").cast("string").alias("text"))


def ingest_documents(spark: SparkSession, base, table_path: str, kinds: Iterable[str] = ("bytes", "asm"),
                     files_per_partition: int = 10_000) -> None:
    """Write the document files once as a Parquet table ``[hash, text]`` in
    ``{table_path}/kind=...``, so that later runs neither list nor open
    millions of small files.  Each task writes the files that it has read."""
    for kind in kinds:
        (scan_documents(spark, base, kind).write.option("maxRecordsPerFile", files_per_partition)
         .parquet(f"{table_path}/kind={kind}"))


def _empty_documents(spark: SparkSession, hashes: DataFrame, docs: DataFrame, base: str, kind: str,
                     table: str | None) -> DataFrame | None:
    """``[hash]`` of the listed documents that the scan has not, or None if
    there are none.  Spark's file scans skip files of length 0, so names
    without a scanned text are joined with the names of all files: one job
    finds the empty documents, whatever their number, and the names of no
    document, which are an error."""
    unscanned = hashes.join(docs.select("hash"), "hash", "left_anti")  # names only: no content is read
    names = document_names(spark, base, kind).select("hash", F.lit(True).alias("listed"))
    # An ingested table has no hole for a file that is not empty.
    filled = (scan_documents(spark, base, kind).select("hash", F.lit(True).alias("filled")) if table
              else names.select("hash", F.lit(False).alias("filled")).where(F.lit(False)))
    found = written(unscanned.join(names, "hash", "left").join(filled, "hash", "left").select(
        "hash", F.col("listed").isNotNull().alias("listed"), F.col("filled").isNotNull().alias("filled")), "empty")
    bad = found.where("filled OR NOT listed").first()
    if bad is not None:
        url = f"{base}/{kind}/{bad['hash']}.{kind}"
        if bad["filled"]:
            raise ValueError(f"document is not in the ingested table: {url}")
        raise FileNotFoundError(f"document not found: {url} (missing, hidden or nested)")
    return None if found.isEmpty() else found.select("hash")


def _reading_tasks(spark: SparkSession, names: DataFrame) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-names.count() // NAMES_PER_TASK))


def _listed(spark: SparkSession, hashes: DataFrame, base: str, kind: str) -> DataFrame:
    """``[hash, size]`` of the listed documents; a name of no document fails.
    The manifest says which files there are: the driver holds no folder's
    listing, whose size would be the number of documents."""
    hashes = written(hashes, "names")
    tasks = _reading_tasks(spark, hashes)
    found = written(file_sizes(hashes.repartition(tasks, "hash"), base, kind), "sizes")
    bad = found.where("size IS NULL").first()
    if bad is not None:
        raise FileNotFoundError(f"document not found: {base}/{kind}/{bad['hash']}.{kind} (missing, hidden or nested)")
    return found.repartition(tasks, "hash")


def _texts(spark: SparkSession, hashes: DataFrame, base: str, kind: str, table: str | None) -> DataFrame:
    """``[hash, text]`` with a row for each distinct listed hash, whatever
    the number of hashes: the tasks open the files by name (where they can
    not, and for a table, one scan of the documents, joined on the name).  A
    listed document that does not exist fails here, before any text is
    read; a zero-length file is an empty document."""
    if not table and opens_by_name(base):
        return _listed(spark, hashes, base, kind).select("hash", text_of(spark, F.col("hash"), base, kind).alias("text"))
    docs = (spark.read.parquet(f"{table}/kind={kind}").select("hash", "text") if table
            else scan_documents(spark, base, kind))
    empty = _empty_documents(spark, hashes, docs, base, kind, table)
    if empty is None:
        return docs
    return docs.unionByName(empty.select("hash", F.lit("").alias("text")))


def read_documents(spark: SparkSession, manifest: DataFrame, base="./data", kind: str = "bytes",
                   aliases: Mapping[str, str] | None = None, table: str | None = None,
                   prefilter: bool = False) -> DataFrame:
    """``DataFrame[id, hash, url, text, ...]``: one row per manifest line that
    names a document (blank lines match nothing; duplicates give one row
    per line).  Further columns of ``manifest`` (labels) are kept.  ``kind``
    is ``bytes`` or ``asm``; ``table`` is an ingested corpus to read instead
    of the files (zero-length files are still looked up at ``base``).
    ``prefilter`` drops most texts that are not listed before the join, for
    manifests too big to broadcast (``likely_listed``).

    Files that tasks can open by name are opened by the tasks that have the
    manifest's lines: no join has texts, which Spark takes for 20 bytes each
    and would collect on the driver to broadcast them."""
    if kind not in ("bytes", "asm"):
        raise ValueError(f"kind must be 'bytes' or 'asm', got {kind!r}")
    base = normalize_base(base, aliases)
    wanted = manifest.where(F.col("hash") != "")
    hashes = wanted.select("hash").distinct()
    url = F.concat(F.lit(f"{base}/{kind}/"), F.col("hash"), F.lit(f".{kind}"))
    extra = [c for c in wanted.columns if c not in ("id", "hash")]
    if not table and opens_by_name(base):
        _listed(spark, hashes, base, kind)
        lines = wanted.repartition(_reading_tasks(spark, wanted), "id", "hash")
        text = text_of(spark, F.col("hash"), base, kind)
        return lines.select("id", "hash", url.alias("url"), text.alias("text"), *extra)
    texts = _texts(spark, hashes, base, kind, table)
    if prefilter:
        texts = likely_listed(texts, wanted, "hash")
    return wanted.join(texts, "hash").select("id", "hash", url.alias("url"), "text", *extra)


def tokenize(text, kind: str, vocabulary: Iterable[str] | None = None,
             lowercase: bool = False) -> Column:
    if kind == "bytes":
        return byte_tokens(text, lowercase)
    if kind == "asm":
        return asm_tokens(text, vocabulary, lowercase)
    if kind == "joint":
        return joint_tokens(text, vocabulary, lowercase)
    raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")


def joint_corpus(bytes_docs: DataFrame, asm_docs: DataFrame, key: str = "id",
                 vocabulary: Iterable[str] | None = None, lowercase: bool = False,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``[key, *keep, features]``: tokens of ``bytes + "\\n\\n" + asm`` per key
    (``keep`` columns come from the bytes side).

    Each side is tokenized next to its own scan and only the token lists are
    joined, so the (large) texts are never shuffled."""
    b = bytes_docs.select(key, *keep,
                          joint_tokens(with_line_break("text"), vocabulary, lowercase).alias("_b"))
    a = asm_docs.select(key, joint_tokens("text", vocabulary, lowercase).alias("_a"))
    return b.join(a, key).select(key, *keep, join_token_lists("_b", "_a").alias("features"))


def joint_token_bags(bytes_docs: DataFrame, asm_docs: DataFrame, key: str = "hash",
                     vocabulary: Iterable[str] | None = None, lowercase: bool = False) -> DataFrame:
    """``[key, features]``: the joint tokens of each document as a bag (the
    order is lost), for models that only count.

    Joint counts are the sums of both sides' counts, so every side is
    counted next to its scan and only ``(key, token, count)`` rows are
    shuffled: neither texts nor token lists."""
    b = bytes_docs.select(key, joint_tokens(with_line_break("text"), vocabulary, lowercase).alias("_t"))
    a = asm_docs.select(key, joint_tokens("text", vocabulary, lowercase).alias("_t"))
    sides = [explode_tokens(x, "_t", "token", keep=(key,)) for x in (b, a)]
    counts = sides[0].unionByName(sides[1]).groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    bags = counts.groupBy(key).agg(F.flatten(F.collect_list(
        F.array_repeat("token", F.col("n").cast("int")))).alias("features"))
    keys = bytes_docs.select(key).join(asm_docs.select(key), key, "left_semi")
    return keys.join(bags, key, "left").select(
        key, F.coalesce("features", F.array().cast("array<string>")).alias("features"))


def labelled_manifest(spark: SparkSession, manifest, labels=None) -> DataFrame:
    """``[id, hash(, label)]``: the manifest's lines that name a document,
    with their labels (inner join on ``id``: surplus lines on either side
    drop out) -- before any document is opened."""
    man = manifest if isinstance(manifest, DataFrame) else read_manifest(spark, manifest)
    wanted = man.where(F.col("hash") != "").select("id", "hash")
    if labels is None:
        return wanted
    return wanted.join(labels if isinstance(labels, DataFrame) else read_labels(spark, labels), "id")


def load_corpus(spark: SparkSession, manifest, labels=None, base="./data", kind: str = "bytes",
                vocabulary: Iterable[str] | None = None, lowercase: bool = False,
                aliases: Mapping[str, str] | None = None, table: str | None = None,
                ordered: bool = True, prefilter: bool = False) -> DataFrame:
    """Labelled (or unlabelled) token corpus.

    bytes / asm -> ``[id, url, features]``; joint -> ``[id, features]``;
    plus ``label bigint`` when ``labels`` is given.  Labels join the
    manifest first, so only labelled documents are read and tokenized.
    ``table``: an ingested corpus (``ingest_documents``).  ``ordered=False``
    gives joint tokens as bags (``joint_token_bags``); for ordered ones
    without a shuffle see ``bucketed_joint_corpus``.  ``prefilter``: see
    ``read_documents``.  Caching is left to the caller.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")
    wanted = labelled_manifest(spark, manifest, labels)
    label = [] if labels is None else ["label"]
    if kind != "joint":
        docs = read_documents(spark, wanted, base, kind, aliases, table, prefilter)
        return docs.select("id", "url", tokenize("text", kind, vocabulary, lowercase).alias("features"), *label)
    base_url = normalize_base(base, aliases)
    hashes = wanted.select("hash").distinct()
    texts = [_texts(spark, hashes, base_url, side, table) for side in ("bytes", "asm")]
    if prefilter:
        texts = [likely_listed(t, hashes, "hash") for t in texts]
    listed = [t.join(hashes, "hash", "left_semi") for t in texts]
    if ordered:
        per_hash = joint_corpus(*listed, key="hash", vocabulary=vocabulary, lowercase=lowercase)
    else:
        per_hash = joint_token_bags(*listed, vocabulary=vocabulary, lowercase=lowercase)
    return wanted.join(per_hash, "hash").select("id", "features", *label)
