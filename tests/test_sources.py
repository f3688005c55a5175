"""File sources: line numbering, manifest, labels, documents, corpus."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import ASM0, BYTES0, make_dataset, write
from corpusml.sources import (
    document_names, document_url, explode_lines, ingest_documents, load_corpus, normalize_base, read_documents,
    read_labels, read_lines, read_manifest, write_documents,
)


def lines_of(spark, path):
    return [(r.id, r.line) for r in read_lines(spark, path).orderBy("id").collect()]


@pytest.mark.parametrize("text,want", [
    ("a\nb\nc\n", ["a", "b", "c"]),
    ("a\nb\nc", ["a", "b", "c"]),
    ("a\r\nb\r\n", ["a", "b"]),
    ("a\n\nb\n", ["a", "", "b"]),
    ("", []),
])
def test_read_lines_variants(spark, scratch, text, want):
    p = write(f"{scratch}/m.txt", text)
    assert lines_of(spark, p) == list(enumerate(want))


def test_read_lines_many_splits(spark, scratch):
    """A file cut into many splits is numbered in file order."""
    n = 20000
    p = write(f"{scratch}/big.txt", "".join(f"line-{i:06d}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_lines(spark, p)
        got = df.orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.id for r in got] == list(range(n))
    assert all(r.line == f"line-{r.id:06d}" for r in got)


def test_explode_lines_matches_file_reader(spark, scratch):
    texts = ["a\nb\n", "x\r\ny", "", "\n", "p\n\nq"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {}
    for r in explode_lines(df, "text", ["k"]).collect():
        got.setdefault(r.k, []).append((r.line_no, r.line))
    for k, t in enumerate(texts):
        p = write(f"{scratch}/f{k}.txt", t)
        assert sorted(got.get(k, [])) == lines_of(spark, p)


def test_manifest_keeps_duplicates_and_blanks(spark, scratch):
    p = write(f"{scratch}/x.txt", "h1\nh2\n\nh1\n")
    assert [tuple(r) for r in read_manifest(spark, p).orderBy("id").collect()] == \
        [(0, "h1"), (1, "h2"), (2, ""), (3, "h1")]


def test_labels_parse(spark, scratch):
    p = write(f"{scratch}/y.txt", "1\n 3 \n9\t\n")
    assert [tuple(r) for r in read_labels(spark, p).orderBy("id").collect()] == [(0, 1), (1, 3), (2, 9)]
    assert dict(read_labels(spark, p).dtypes)["label"] == "bigint"


def test_malformed_label_fails(spark, scratch):
    p = write(f"{scratch}/y.txt", "1\nx\n")
    with pytest.raises(Exception, match="not an integer"):
        read_labels(spark, p).collect()


def test_document_url(spark, scratch):
    df = spark.createDataFrame([("abc",)], "h string")
    assert df.select(document_url("h", "gs://bucket/data", "asm")).first()[0] == "gs://bucket/data/asm/abc.asm"
    local = df.select(document_url("h", scratch, "bytes")).first()[0]
    assert local == f"file:{os.path.realpath(scratch)}/bytes/abc.bytes"
    assert normalize_base("gs", {"gs": "gs://b/p"}) == "gs://b/p"


@pytest.fixture()
def dataset(scratch):
    docs = {
        "h1": (BYTES0, ASM0),
        "h2": ("00401000 AA BB CC\n", ".text:00401000 push ebp\r\n.text:00401001 call x\r\n"),
        "h3": ("", ""),
    }
    root = make_dataset(f"{scratch}/data", docs)
    write(f"{scratch}/train_x", "h1\nh2\nh1\n\nh3\n")
    write(f"{scratch}/train_y", "3\n1\n2\n5\n4\n")
    return scratch, root


def test_read_documents(spark, dataset):
    scratch, root = dataset
    man = read_manifest(spark, f"{scratch}/train_x")
    rows = read_documents(spark, man, root, "bytes").orderBy("id").collect()
    assert [(r.id, r.hash) for r in rows] == [(0, "h1"), (1, "h2"), (2, "h1"), (4, "h3")]
    assert rows[0].text == BYTES0 and rows[3].text == ""  # h3 is a zero-length file
    assert rows[1].url == f"file:{os.path.realpath(root)}/bytes/h2.bytes"
    # an ingested corpus gives the same rows
    ingest_documents(spark, root, f"{scratch}/table")
    again = read_documents(spark, man, root, "bytes", table=f"{scratch}/table").orderBy("id").collect()
    assert again == rows


ODD_NAMES = ["a b", "p%41", "p%20q", "1+1", "s*", "q?", "[x]", "{h1,h2}", "é🙂", "semi;colon", "back\\slash"]


def test_odd_names_are_plain_names(spark, scratch):
    """Blanks, percent signs, glob characters: files and base folder."""
    root = make_dataset(f"{scratch}/d{{a}} [b] 100%/data", {n: (f"00401000 AA {i:02X}", "") for i, n in enumerate(ODD_NAMES)})
    write(f"{scratch}/x", "".join(n + "\n" for n in ODD_NAMES))
    docs = read_documents(spark, read_manifest(spark, f"{scratch}/x"), root, "bytes")
    assert [(r.hash, r.text) for r in docs.orderBy("id").collect()] == [
        (n, f"00401000 AA {i:02X}") for i, n in enumerate(ODD_NAMES)]


@pytest.mark.parametrize("name", ["h*", "{h1,h2}", "h?", "[h]1", "nope", "../bytes/nope", ".hidden"])
def test_names_of_no_document_fail(spark, dataset, name):
    """Also when no text is needed."""
    scratch, root = dataset
    write(f"{root}/bytes/.hidden.bytes", "00 AA")
    write(f"{scratch}/odd_x", f"h1\n{name}\n")
    with pytest.raises((FileNotFoundError, ValueError), match="document (not found|cannot be scanned)"):
        load_corpus(spark, f"{scratch}/odd_x", None, root, "bytes").count()


def test_labels_alone_read_no_document(spark, scratch):
    """A document of 3 GiB does not fit into a row; its label does."""
    root = make_dataset(f"{scratch}/data", {"h1": (BYTES0, ASM0), "big": ("x", "x")})
    with open(f"{root}/bytes/big.bytes", "r+b") as f:
        f.truncate(3 << 30)  # sparse: takes no disk
    write(f"{scratch}/x", "h1\nbig\n")
    write(f"{scratch}/y", "1\n2\n")
    corpus = load_corpus(spark, f"{scratch}/x", f"{scratch}/y", root, "bytes")
    assert sorted(map(tuple, corpus.groupBy("label").count().collect())) == [(1, 1), (2, 1)]


def test_unlabelled_documents_are_not_read(spark, dataset):
    scratch, root = dataset
    write(f"{scratch}/one_y", "3\n")
    plan = load_corpus(spark, f"{scratch}/train_x", f"{scratch}/one_y", root, "bytes")._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    tokens = next(i for i, x in enumerate(lines) if "regexp_extract_all" in x)
    assert any("Join" in x for x in lines[tokens:])  # tokens are made above the joins with labels and manifest


def test_load_corpus_kinds(spark, dataset):
    scratch, root = dataset
    vocab = ["lea", "push", "call", "mov"]
    b = load_corpus(spark, f"{scratch}/train_x", f"{scratch}/train_y", root, "bytes")
    assert b.columns == ["id", "url", "features", "label"]
    got = {r.id: (r.features, r.label) for r in b.collect()}
    assert got[0] == ("56 8D 44 24 08 50 8B F1 2A E8 1C 1B 00 00".split(), 3)
    assert got[1] == (["AA", "BB", "CC"], 1) and got[4] == ([], 4)
    a = load_corpus(spark, f"{scratch}/train_x", None, root, "asm", vocabulary=vocab)
    assert a.columns == ["id", "url", "features"]
    got = {r.id: r.features for r in a.collect()}
    assert got[0] == [".text:", "lea", ".text:", "mov", ".rsrc:", "push", "call"]
    assert got[1] == [".text:", "push", ".text:", "call"]
    j = load_corpus(spark, f"{scratch}/train_x", f"{scratch}/train_y", root, "joint", vocabulary=vocab)
    assert j.columns == ["id", "features", "label"]
    got = {r.id: r.features for r in j.collect()}
    assert got[0] == ["56 8D", "44 24", "08 50", "8B F1", "E8 1C", "1B 00",
                      ".text:", "56 8D", "44 24", "lea", ".text:", "mov", ".rsrc:", "push", "call"]
    assert got[2] == got[0] and got[4] == []
    # as bags: the same tokens in any order, and no token list below a join or shuffle
    bags = load_corpus(spark, f"{scratch}/train_x", f"{scratch}/train_y", root, "joint", vocabulary=vocab, ordered=False)
    assert {r.id: sorted(r.features) for r in bags.collect()} == {i: sorted(f) for i, f in got.items()}


def test_lowercase_reproduces_default_tokenizer(spark, dataset):
    from pyspark.ml.feature import RegexTokenizer
    scratch, root = dataset
    docs = read_documents(spark, read_manifest(spark, f"{scratch}/train_x"), root, "bytes")
    ours = load_corpus(spark, f"{scratch}/train_x", None, root, "bytes", lowercase=True)
    ml = RegexTokenizer(inputCol="text", outputCol="t", gaps=False, pattern="(?<= )[0-9A-F]{2}").transform(docs)
    want = {r.id: r.t for r in ml.collect()}
    assert {r.id: r.features for r in ours.collect()} == want


def test_kind_is_honoured_and_checked(spark, dataset):
    scratch, root = dataset
    with pytest.raises(ValueError):
        load_corpus(spark, f"{scratch}/train_x", None, root, "exe")


def test_labels_shorter_than_manifest(spark, dataset):
    scratch, root = dataset
    write(f"{scratch}/short_y", "3\n1\n")
    df = load_corpus(spark, f"{scratch}/train_x", f"{scratch}/short_y", root, "bytes")
    assert sorted(r.id for r in df.collect()) == [0, 1]


def test_empty_manifest(spark, dataset):
    scratch, root = dataset
    write(f"{scratch}/empty_x", "")
    df = load_corpus(spark, f"{scratch}/empty_x", None, root, "bytes")
    assert df.count() == 0 and df.columns == ["id", "url", "features"]


def test_missing_document_fails(spark, dataset):
    scratch, root = dataset
    write(f"{scratch}/bad_x", "h1\nnope\n")
    for kind in ("bytes", "asm", "joint"):
        with pytest.raises(FileNotFoundError, match="document not found"):
            load_corpus(spark, f"{scratch}/bad_x", None, root, kind)


def test_hot_hash_in_manifest(spark, dataset):
    """One hash on most manifest lines: every line keeps its own document."""
    scratch, root = dataset
    hashes = ["h1"] * 900 + ["h2"] * 50 + ["h1"] * 50
    write(f"{scratch}/hot_x", "".join(h + "\n" for h in hashes))
    man = read_manifest(spark, f"{scratch}/hot_x")
    rows = read_documents(spark, man, root, "bytes").select("id", "hash").collect()
    assert sorted((r.id, r.hash) for r in rows) == list(enumerate(hashes))


def test_read_lines_several_files(spark, scratch):
    write(f"{scratch}/d/a.txt", "a0\na1\n")
    write(f"{scratch}/d/b.txt", "b0\n")
    assert lines_of(spark, f"{scratch}/d") == [(0, "a0"), (1, "a1"), (2, "b0")]


def test_empty_documents_are_not_kept_on_the_driver(spark, scratch, monkeypatch):
    root = make_dataset(f"{scratch}/hollow", {f"e{i}": ("" if i % 3 else BYTES0, ASM0) for i in range(12)})
    manifest = spark.range(12).select("id", F.concat(F.lit("e"), F.col("id").cast("string")).alias("hash"))

    def kept(*_, **__):
        raise AssertionError("rows from the driver")

    monkeypatch.setattr(spark, "createDataFrame", kept)
    rows = read_documents(spark, manifest, root, "bytes").collect()
    assert {r["id"]: r["text"] for r in rows} == {i: "" if i % 3 else BYTES0 for i in range(12)}


def test_written_documents_read_back(spark, scratch):
    """One file per row, by names of any kind; empty and null texts are empty files."""
    texts = {"h1": "a\nb", "with blank": "é\r\n", "100%": "x", "a*[b]": "glob", "leer": "", "null": None, "dot.name": "y"}
    rows = spark.createDataFrame([*texts.items(), ("h1", "a\nb")], "hash string, text string")
    write_documents(rows.repartition(3), f"file:{scratch}/out", "bytes")
    assert sorted(os.listdir(f"{scratch}/out/bytes")) == sorted(f"{h}.bytes" for h in texts)
    with open(f"{scratch}/out/bytes/with blank.bytes", newline="") as f:
        assert f.read() == "é\r\n"
    assert sorted(r["hash"] for r in document_names(spark, f"file:{scratch}/out", "bytes").collect()) == sorted(texts)
    manifest = spark.createDataFrame(list(enumerate(texts)), "id long, hash string")
    got = {r["hash"]: r["text"] for r in read_documents(spark, manifest, f"{scratch}/out", "bytes").collect()}
    assert got == {h: t or "" for h, t in texts.items()}


def test_bad_document_names_are_not_written(spark, scratch):
    for name in ("", "a/b", ".hidden", "_meta", None):
        with pytest.raises(Exception, match="not a document name"):
            write_documents(spark.createDataFrame([(name, "x")], "hash string, text string"), f"file:{scratch}/bad", "asm")


def test_names_of_an_empty_folder(spark, scratch):
    os.makedirs(f"{scratch}/none/bytes")
    assert document_names(spark, f"file:{scratch}/none", "bytes").collect() == []


def test_many_empty_documents(spark, scratch):
    """Names without a text take no step of their own on the driver."""
    n = 20_000
    os.makedirs(f"{scratch}/many/bytes")
    for i in range(n):
        open(f"{scratch}/many/bytes/e{i}.bytes", "w").close()
    manifest = spark.range(n).select("id", F.concat(F.lit("e"), F.col("id").cast("string")).alias("hash"))
    docs = read_documents(spark, manifest, f"{scratch}/many", "bytes")
    assert docs.agg(F.count("*"), F.max(F.length("text"))).first() == (n, 0)


def test_ingested_table_without_a_document_fails(spark, scratch):
    root = make_dataset(f"{scratch}/part", {"h1": (BYTES0, ASM0)})
    ingest_documents(spark, root, f"{scratch}/table", ("bytes",))
    make_dataset(root, {"h2": (BYTES0, ASM0), "h3": ("", ASM0)})
    manifest = spark.createDataFrame([(0, "h1"), (1, "h3")], "id long, hash string")
    rows = read_documents(spark, manifest, root, "bytes", table=f"{scratch}/table").collect()
    assert {r["hash"]: r["text"] for r in rows} == {"h1": BYTES0, "h3": ""}
    with pytest.raises(ValueError, match="not in the ingested table"):
        read_documents(spark, spark.createDataFrame([(0, "h2")], "id long, hash string"), root, "bytes",
                       table=f"{scratch}/table")


def test_listed_documents_need_no_listing_of_the_folder(spark, dataset, monkeypatch):
    """The driver holds no entry per file: tasks open the manifest's files by name."""
    from corpusml.sources import corpus
    scratch, root = dataset

    def listed(*_, **__):
        raise AssertionError("folder listed on the driver")

    monkeypatch.setattr(corpus, "scan_documents", listed)
    monkeypatch.setattr(corpus, "document_names", listed)
    rows = read_documents(spark, read_manifest(spark, f"{scratch}/train_x"), root, "bytes").orderBy("id").collect()
    assert [(r.id, r.text) for r in rows if r.hash != "h2"] == [(0, BYTES0), (2, BYTES0), (4, "")]
    joint = load_corpus(spark, f"{scratch}/train_x", f"{scratch}/train_y", root, "joint", vocabulary=["lea"])
    assert sorted(r.id for r in joint.select("id").collect()) == [0, 1, 2, 4]


def moved(node) -> set[str]:
    """Names of the columns that a plan shuffles or broadcasts."""
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.initialPlan()
    own = {node.output().apply(i).name() for i in range(node.output().size())} if "Exchange" in node.nodeName() else set()
    return own.union(*(moved(node.children().apply(i)) for i in range(node.children().size())))


def test_texts_of_files_are_not_broadcast(spark, dataset):
    """A manifest of many lines and few names: its texts look smaller than its lines."""
    scratch, root = dataset
    name = F.concat(F.lit("h"), (F.col("id") % 2 + 1).cast("string"))
    manifest = spark.range(50_000).select("id", name.alias("hash"))
    docs = read_documents(spark, manifest, root, "bytes")
    assert "text" not in moved(docs._jdf.queryExecution().executedPlan())
    assert [r.text == BYTES0 for r in docs.where("id < 3").orderBy("id").collect()] == [True, False, True]
    assert docs.count() == 50_000


def test_writing_documents_starts_no_python_beside_the_driver(spark, scratch, monkeypatch):
    """Spark plans and commits a Python data source's write in Python processes of the driver."""
    from pyspark.sql.datasource import DataSourceRegistration

    def registered(*_):
        raise AssertionError("a Python data source")

    monkeypatch.setattr(DataSourceRegistration, "register", registered)
    rows = spark.range(50).select(F.col("id").cast("string").alias("hash"), F.lit("AA").alias("text"))
    write_documents(rows, f"file:{scratch}/out", "bytes")
    assert sorted(os.listdir(f"{scratch}/out/bytes")) == sorted(f"{i}.bytes" for i in range(50))
