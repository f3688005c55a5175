"""Document files as a table: names with empty files, and a writer that
makes one file per row.

Spark's file scans skip files of length 0 and its writers choose the file
names, so both ends of the one-file-per-document layout
``{base}/{kind}/{hash}.{kind}`` need a source and a sink of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.session import package_on_workers


def document_names(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """``[hash]`` of every document file of the folder, empty files too.

    The names are those of the file index that Spark lists for any scan of
    the folder; they stay in the JVM, which deals them to tasks, so nothing is
    looked up one by one or passes through Python."""
    files = spark.read.format("binaryFile").load(f"{glob_escaped(base)}/{kind}")._jdf.inputFiles()
    scala = spark._jvm.scala
    listed = scala.jdk.javaapi.CollectionConverters.asJava(scala.collection.immutable.ArraySeq.unsafeWrapArray(files))
    names = spark.sparkContext._jsc.parallelize(listed)
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    urls = DataFrame(spark._jsparkSession.createDataset(names.rdd(), encoder).toDF(), spark)
    path = F.url_decode(F.replace(F.col("value"), F.lit("+"), F.lit("%2B")))
    return urls.select(F.regexp_extract(path, rf"(?s)/{kind}/([^/]*)\.{kind}$", 1).alias("hash")).where("hash <> ''")


def glob_escaped(path: str) -> str:
    return "".join("\\" + c if c in "\\{}[]*?" else c for c in path)


def filesystem(url: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder URL and the folder's path in it."""
    if url.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + url.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(url.replace("s3a://", "s3://", 1))


def opens_by_name(base: str) -> bool:
    """Whether tasks can open the files of this folder by their names."""
    try:
        filesystem(base)
    except (pa.ArrowException, OSError, NotImplementedError):
        return False
    return True


#: Names that a task has in hand at least, and bytes of texts that it passes on at once.
NAMES_PER_TASK, PASSED_BYTES, OPEN_FILES = 2000, 8 << 20, 4


def _path(folder: str, name: str | None, kind: str) -> str | None:
    """The file of a document; none for names that Spark's scans hide or that lie elsewhere."""
    return f"{folder}/{name}.{kind}" if name and "/" not in name and name[0] not in "._" else None


def file_sizes(names: DataFrame, base: str, kind: str) -> DataFrame:
    """``names [hash]`` with the ``size`` of each document's file, null
    without one: looked up where the names are, no folder is listed."""
    package_on_workers(names.sparkSession)
    url = f"{base}/{kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(url)
        for batch in batches:
            paths = [_path(folder, x, kind) for x in batch.column(0).to_pylist()]
            found = iter(fs.get_file_info([x for x in paths if x is not None]))
            infos = [None if x is None else next(found) for x in paths]
            sizes = [i.size if i is not None and i.type == arrow_fs.FileType.File else None for i in infos]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["hash", "size"])

    return names.select("hash").mapInArrow(run, "hash string, size long")


def text_of(spark: SparkSession, name: Column, base: str, kind: str) -> Column:
    """The content of the document ``name`` as a column, read by the task
    that has the name: a plan that drops the column opens no file, and texts
    are passed on some ``PASSED_BYTES`` at a time."""
    package_on_workers(spark)
    url = f"{base}/{kind}"

    @F.arrow_udf("binary")
    def document_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fs, folder = filesystem(url)

        def read(path: str) -> bytes:
            with fs.open_input_stream(path) as file:
                return file.read()

        with ThreadPoolExecutor(OPEN_FILES) as pool:
            for batch in batches:
                paths = [_path(folder, x, kind) for x in batch.to_pylist()]
                held, size = [], 0
                for k in range(0, len(paths), OPEN_FILES):
                    held += pool.map(read, paths[k:k + OPEN_FILES])
                    size += sum(map(len, held[-OPEN_FILES:]))
                    if size >= PASSED_BYTES:
                        yield pa.array(held, pa.binary())
                        held, size = [], 0
                if held or not paths:
                    yield pa.array(held, pa.binary())

    return document_text(name).cast("string")


def write_documents(docs: DataFrame, base: str, kind: str) -> None:
    """``docs [hash, text]`` as one file ``{base}/{kind}/{hash}.{kind}`` per
    row; a null text is an empty file.  Equal names have to hold equal texts:
    the last one written stays.

    Every task writes the files of its own rows.  A file gets its name only
    when it is whole, so a task that is lost and run again (or run twice)
    leaves each document once.  A Python data source would do the same, but
    keeps Python processes beside the driver to plan and commit the write."""
    package_on_workers(docs.sparkSession)
    url = f"{base}/{kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(url)
        fs.create_dir(folder, recursive=True)
        for batch in batches:
            names, texts = batch.column("hash"), batch.column("text")
            for name, text in zip(names.to_pylist(), texts.to_pylist(), strict=True):
                if not name or "/" in name or name[0] in "._":
                    raise ValueError(f"not a document name: {name!r}")
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write((text or "").encode())
                fs.move(part, f"{folder}/{name}.{kind}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    texts = docs.select(F.col("hash").cast("string"), F.col("text").cast("string"))
    texts.mapInArrow(run, "files long").write.format("noop").mode("overwrite").save()
