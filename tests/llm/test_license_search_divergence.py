"""License scan, ranked search and divergence audit against brute force and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF001
from corpusml.llm import common, divergence, licenses, rankedsearch, registry
from scripts.check_oracle import digest

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "...", "a", "MIT License", "mit license " * 40, "é" * 50, "ÀB c" * 30, "x" * 200_000, "a b " * 30_000,
       "MIT License", "MIT License"]
#: Names of columns that the operators use inside.
CLASHES = ("row", "id", "text_key", "n_words", "hash", "pos", "template", "term", "words", "prefix", "stem", "rank",
           "score", "shard", "block", "w", "k", "spans", "n", "p", "p0", "value", "query", "tf")


def frame(spark, texts, ids=None, langs=None, sources=None):
    rows = [(i, t, a, b, *["clash"] * len(CLASHES)) for i, t, a, b in zip(
        ids or range(len(texts)), texts, langs or ["l"] * len(texts), sources or ["s"] * len(texts), strict=True)]
    extra = "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string{extra}")


def duck(tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_df", df.toPandas() if hasattr(df, "toPandas") else df)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_df")
    return con


def same_as_sql(con, sql, df):
    cur = con.execute(sql)
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(cols) == sorted(df.columns)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(cols, want)


# ---- license scan ---------------------------------------------------------------

def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def brute_base(text):
    w = license_words(text)
    places = [(i, t.label) for t in licenses.PHRASES for i in range(len(w))
              if w[i:i + len(t.text.split())] == t.text.split()]
    return (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({x for _, x in places})))


def brute_exact(text):
    """Labels of all templates that stand word for word."""
    joined = " " + " ".join(license_words(text)) + " "
    return {t.label for t in licenses.TEMPLATES if f" {' '.join(license_words(t.text))} " in joined}


def scanned(docs, **kwargs):
    return licenses.report(*licenses.scan(docs, **kwargs)).collect()


def test_license_base_of_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = registry.QUERIES["op11_license_scan"](spark, SF001).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(texts[r["doc_id"]])
        assert brute_exact(texts[r["doc_id"]]) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_license_odd_rows_and_clashing_columns(spark):
    texts = [*ODD, "GNU  General\nPublic-License, version 3.", "cc by cc by", "Apache License apache license " * 20]
    ids = [*range(len(texts) - 1), None]
    rows = {r["id"]: r for r in scanned(frame(spark, texts, ids))}
    for i, t in zip(ids, texts, strict=True):
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t)
    assert rows[13]["labels"] == "gpl,gpl-3.0"
    repeated = scanned(frame(spark, ["MIT License"] * 3, [7, 7, 7]))
    assert [(r["id"], r["n_base"]) for r in repeated] == [(7, 1)] * 3
    assert scanned(frame(spark, ["x"]).where("false")) == []
    assert [r["labels"] for r in scanned(frame(spark, ["MIT License"]), templates=[])] == [""]


def test_license_notices_with_changed_words(spark):
    notice = next(t for t in licenses.NOTICES if t.label == "mit-notice").text.split()
    rng = random.Random(5)
    noise = [f"w{rng.randrange(9999)}" for _ in range(400)]
    left_out = notice[:20] + notice[22:]
    put_in = notice[:15] + ["new", "words"] + notice[15:]
    changed = [*notice[:25], "other", *notice[26:]]
    halved = notice[:len(notice) // 2]
    texts = [" ".join([*noise[:50], *part, *noise[50:]]) for part in (notice, left_out, put_in, changed, halved, noise)]
    rows = sorted(scanned(frame(spark, texts)), key=lambda r: r["id"])
    assert [r["labels"] for r in rows] == ["mit-notice"] * 4 + ["", ""]
    assert rows[0]["score"] == 1.0 and all(0.8 <= r["score"] < 1 for r in rows[1:4])
    # A version that is not the template's is not its label.
    [r] = scanned(frame(spark, ["the GNU General Public License, version 4"]))
    assert r["labels"] == "gpl"


def test_license_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common.is_bounded, "__defaults__", (0,))
    monkeypatch.setattr(common.bounded, "__defaults__", (0,))
    rows = scanned(frame(spark, ODD))
    assert [brute_base(t)[1] for t in ODD] == [r["n_base"] for r in sorted(rows, key=lambda r: r["id"])]


def test_license_scan_is_native(spark):
    df = registry.QUERIES["op11_license_scan"](spark, SF001)
    plan = df._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|MapIn|ExistingRDD", plan)


# ---- ranked search --------------------------------------------------------------

def brute_ranks(docs, items, k=10):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UP))

    bags = [Counter(cut(t)) for _, t in docs]
    n_docs, total = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        asked, scores = Counter(cut(text)), []
        for (doc, _), bag in zip(docs, bags, strict=True):
            m = 25 + 75 * sum(bag.values()) * n_docs // total if total else 0
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, c in asked.items() if bag[t])
            scores.append((-s, doc is None, doc))
        best = sorted(x for x in scores if x[0] < 0)[:k]
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(best, 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, **kwargs):
    d = frame(spark, [t for _, t in docs], [i for i, _ in docs])
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, term int, row int")
    rows = rankedsearch.search(d, q, **kwargs).select("id", "rank", "doc_id", "score").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_ranked_search_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    same_as_sql(con, rankedsearch.ORACLE, registry.QUERIES["op12_ranked_search"](spark, SF001))


def test_ranked_search_in_shards_and_blocks(spark, monkeypatch):
    """Many ties, many shards, blocks of queries, small waves."""
    monkeypatch.setattr(rankedsearch, "SHARD_POSTINGS", 60)
    monkeypatch.setattr(rankedsearch, "QUERY_BLOCK", 3)
    monkeypatch.setattr(rankedsearch, "WAVE", 3)
    rng = random.Random(3)
    words = [f"t{chr(97 + k)}" for k in range(12)] + ["ÉÀ", "A", "b2"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(150)]
    docs += [(i, t) for i, t in docs[:20]]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 7)))) for i in range(9)]
    assert ranked(spark, docs, items) == brute_ranks(docs, items)


def test_ranked_search_odd_rows(spark):
    docs = [*enumerate(ODD), (None, "a b"), (3, "a b"), (3, "a b"), (2**60, "A  B"), (2**60 + 1, "a b")]
    items = [(1, "a b"), (1, "A"), (None, "license"), (2, None), (3, ""), (4, "unknown words"), (5, "a a a mit É")]
    assert ranked(spark, docs, items) == brute_ranks(docs, items)
    assert ranked(spark, docs, []) == []
    assert ranked(spark, [], items) == []


def test_range_maxima_and_bounds():
    """Every range maximum, and the search against scoring all documents."""
    rng = np.random.default_rng(4)
    n, lists = 300, 9
    where = [np.sort(rng.choice(n, size=rng.integers(1, n), replace=False)) for _ in range(lists)]
    terms = np.concatenate([np.full(len(w), 10 * k) for k, w in enumerate(where)])
    docs, impacts = np.concatenate(where), rng.integers(1, 50, sum(map(len, where)))
    mixed = rng.permutation(len(terms))
    shard = rankedsearch.Shard(terms[mixed], docs[mixed], impacts[mixed], n)
    for k in range(lists):
        lo, hi = shard.starts[k], shard.starts[k + 1]
        for a, b in rng.integers(lo, hi + 1, (200, 2)):
            if a < b:
                place = shard.range_best(np.array([a]), np.array([b]))[0]
                assert a <= place < b and shard.impacts[place] == shard.impacts[a:b].max()
    dense = np.zeros((lists, n), dtype=np.int64)
    dense[terms // 10, docs] = impacts
    for _ in range(100):
        asked = rng.choice(lists, size=rng.integers(1, lists), replace=False)
        weights = rng.integers(0, 5, len(asked))
        total = weights @ dense[asked]
        want = sorted((-s, d) for d, s in enumerate(total.tolist()) if s > 0)[:10]
        got = shard.search(np.append(asked * 10, 7), np.append(weights, 3), 10)
        assert got == [(-s, d) for s, d in want]


# ---- divergence audit -----------------------------------------------------------

def test_divergence_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    same_as_sql(con, divergence.ORACLE, registry.QUERIES["op13_source_divergence"](spark, SF001))


@pytest.mark.parametrize("broadcast", [True, False])
def test_divergence_odd_rows(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(common.is_bounded, "__defaults__", (0,))
        monkeypatch.setattr(common.bounded, "__defaults__", (0,))
    rng = random.Random(8)
    long = "q" * 5000
    words = ["a", "ab", "abc", "abcd", "abcdefgh", "É", "éé", "Ünder", long, long + "z", "B", "b", "x1y"]
    texts = ODD + [" ".join(rng.choices(words, k=rng.randrange(0, 12))) for _ in range(300)]
    langs = [rng.choice(["en", "fr", None, ""]) for _ in texts]
    sources = [rng.choice(["s1", "s2", "É", "z", None]) for _ in texts]
    texts += ["only once here", ""]
    langs, sources = [*langs, "lone", "lone"], [*sources, "s1", "s2"]
    docs = frame(spark, texts, None, langs, sources)
    same_as_sql(duck({"documents": docs.select("doc_id", "text", "lang", "source")}), divergence.ORACLE, divergence.audit(docs))


def test_kept_terms_by_every_first_prefix(spark):
    """The levels find the same terms wherever they begin."""
    rng = random.Random(9)
    alphabet = ["a", "b", "é"]
    texts = [" ".join("".join(rng.choices(alphabet, k=rng.randrange(1, 7))) for _ in range(rng.randrange(0, 30)))
             for _ in range(80)]
    common.prepare(spark)
    lists = common.materialize(divergence.term_lists(frame(spark, texts)), "terms")
    df = Counter(w for t in texts for w in set(t.split()))
    want = {w.encode() + b"\0": n for w, n in df.items() if n >= 10}
    for first in (1, 2, 5, 40):
        got = {r["term"].encode("latin-1"): r["n_docs"] for r in divergence.kept_terms(lists, 10, first).collect()}
        assert got == want


@pytest.mark.parametrize("cut", [1, 200, 8 << 20])
def test_term_sums_of_slices(spark, monkeypatch, cut):
    """Terms are summed per group before Spark sees them, by occurrences and by documents."""
    monkeypatch.setattr(divergence, "SLICE_BYTES", cut)
    rng = random.Random(10)
    texts = ODD + [" ".join(rng.choices(["a", "B", "b", "é", "É", "ab1c", "a-a"], k=rng.randrange(0, 9))) for _ in range(90)]
    groups = [(rng.choice("xy"), rng.choice("st")) for _ in texts]
    rows = divergence.term_lists(frame(spark, texts, None, *zip(*groups, strict=True)).coalesce(1)).collect()
    n, docs = Counter(), Counter()
    for r in rows:
        if r["term"] is not None:
            key = r["lang"], r["source"], r["term"].encode("latin-1")
            n[key] += r["n"]
            docs[key] += r["docs"]
    want_n, want_docs = Counter(), Counter()
    for g, t in zip(groups, texts, strict=True):
        terms = [x.lower() + b"\0" for x in re.findall(rb"[A-Za-z\x80-\xff]+", (t or "").encode())]
        want_n.update((*g, x) for x in terms)
        want_docs.update((*g, x) for x in set(terms))
    assert n == want_n and docs == want_docs
    assert {(r["lang"], r["source"]) for r in rows if r["term"] is None} == set(groups)
    if cut > 200:  # one slice: one row for a term of a group, not one for each document
        assert len(rows) == len(want_n) + len(set(groups))


def test_terms_are_written_once_for_a_language(spark, monkeypatch):
    """Levels read a row for each term of a language, not one for each source; counts are joined by numbers."""
    written = {}

    def kept_aside(df, name):
        written[name] = common.materialize(df, name)
        return written[name]

    monkeypatch.setattr(divergence, "materialize", kept_aside)
    monkeypatch.setattr(divergence, "discard", lambda *tables: None)
    texts = ["alpha beta gamma"] * 60
    groups = [("xy"[i % 2], f"s{i % 6}") for i in range(60)]
    common.prepare(spark)
    assert divergence.audit(frame(spark, texts, None, *zip(*groups, strict=True)).coalesce(1)).count() > 0
    assert written["terms"].count() == 2 * 3 + 2
    assert all(t == "bigint" for c, t in written["frequencies"].dtypes if c != "lang")
    assert written["frequencies"].count() == 6 * 3


@pytest.mark.parametrize("broadcast", [True, False])
def test_divergence_of_many_equal_terms(spark, monkeypatch, broadcast):
    """More terms than ranks have one value: the smallest in UTF-8 are taken."""
    if not broadcast:
        monkeypatch.setattr(common.is_bounded, "__defaults__", (0,))
        monkeypatch.setattr(common.bounded, "__defaults__", (0,))
    rng = random.Random(11)
    words = [a + b for a in ["a", "É", "z", "ÿ", "語"] for b in "qrstuvw"]
    texts = [" ".join(rng.sample(words, len(words))) for _ in range(24)] + ["aq zr"] * 12
    sources = [f"s{i % 2}" for i in range(24)] + ["s2"] * 12
    docs = frame(spark, texts, None, None, sources)
    common.prepare(spark)
    same_as_sql(duck({"documents": docs.select("doc_id", "text", "lang", "source")}), divergence.ORACLE, divergence.audit(docs))


def test_divergence_of_no_rows(spark):
    assert divergence.audit(frame(spark, ["a"]).where("false")).collect() == []


def test_smoothed_frequency_is_exact(spark):
    big = 2**62
    row = spark.createDataFrame([(big, big, 10**9)], "c long, t long, v long").select(
        divergence.smoothed("c", "t", "v").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 2) // (big + 2 * 10**9)
