"""Suffix-array dedup, line dedup, SimHash and decontamination against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001, SF0001
from corpusml.llm import components, decontaminate, linededup, registry, simhash, suffixdedup
from scripts.check_oracle import digest

DOCS = "doc_id long, text string, row long, key string, windows string"


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, 5, "x", "y") for i, t in zip(ids or range(len(texts)), texts)], DOCS)


# ---- repeated byte strings ------------------------------------------------------

def brute_repeats(texts, length):
    data, places = [(t or "").encode() for t in texts], {}
    for k, d in enumerate(data):
        for i in range(len(d) - length + 1):
            places.setdefault(d[i:i + length], []).append((k, i))
    gone = [np.zeros(len(d) + 2, dtype=bool) for d in data]
    for own in places.values():
        if len(own) > 1:
            for k, i in own:
                gone[k][i + 1:i + 1 + length] = True
    out = []
    for d, g in zip(data, gone):
        starts, ends = np.flatnonzero(g[1:] & ~g[:-1]), np.flatnonzero(~g[1:] & g[:-1])
        kept = bytes(b for b, x in zip(d, g[1:]) if not x)
        out.append((len(d), [(int(a), int(b)) for a, b in zip(starts, ends)], hashlib.sha256(kept).hexdigest()))
    return out


def got_repeats(df, length):
    rows = suffixdedup.remove_repeats(df, length=length).collect()
    return sorted((r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], r["kept_sha256"]) for r in rows)


def test_repeats_of_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    want = dict(zip(texts, brute_repeats(texts.values(), 400)))
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.QUERIES["op3_suffix_array_dedup"](spark, SF0001).collect()}
    assert got == {d: (n, sum(b - a for a, b in s), len(s), h) for d, (n, s, h) in want.items()}


def test_many_equal_rows_of_one_id(spark):
    """The work grows with the rows, not with their square."""
    rng = random.Random(11)
    text = "".join(rng.choices("abcdefgh \n", k=20_000))
    other = text[:1000] + "".join(rng.choices("ijkl", k=3000))
    df = frame(spark, [text] * 1500 + [other], [7] * 1500 + [8])
    rows = suffixdedup.remove_repeats(df).collect()
    want = brute_repeats([text, text, other], 400)
    assert len(rows) == 1501
    for r in rows:
        assert (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], r["kept_sha256"]) == want[2 if r["doc_id"] == 8 else 0]


def test_repeats_across_many_shards(spark, monkeypatch):
    """Passages with own surroundings, spread over shards and merged."""
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 1500)
    monkeypatch.setattr(suffixdedup, "SHARD_WINDOWS", 3)
    rng = random.Random(4)
    words = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [words(n) for n in (30, 60, 90, 200)]
    texts = [words(rng.randrange(40)) + rng.choice(passages)[rng.randrange(12):] + words(rng.randrange(40))
             for _ in range(90)]
    texts += [passages[3][:100] * 2, "z" * 300, "z" * 45, "zy" * 60, None, "", texts[0], texts[0], words(5000)]
    want = sorted((i, *w) for i, w in enumerate(brute_repeats(texts, 40)))
    assert got_repeats(frame(spark, texts), 40) == want
    assert sum(len(s) for _, _, s, _ in want) > 50


def test_repeats_with_equal_rows_null_ids_and_no_rows(spark):
    text = "".join(random.Random(1).choice("abcd") for _ in range(100))
    got = got_repeats(frame(spark, [text, text, "short", None], [7, 7, None, 3]).orderBy("doc_id").na.fill({"doc_id": -1}), 40)
    empty = hashlib.sha256(b"").hexdigest()
    assert got[2:] == [(7, 100, [(0, 100)], empty)] * 2
    rows = suffixdedup.remove_repeats(frame(spark, [text, text], [None, None]), length=40).collect()
    assert [len(r["spans"]) for r in rows] == [1, 1]
    assert got_repeats(frame(spark, []), 40) == []


@given(st.lists(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_suffix_array_and_prefixes(strings):
    pad = suffixdedup.PAD
    text = np.frombuffer(b"".join(s + b"\0" * pad for s in strings), dtype=np.uint8)
    first = np.cumsum([0] + [len(s) + pad for s in strings])[:-1]
    end = np.zeros(len(text), dtype=np.int64)
    for a, s in zip(first, strings):
        end[a:a + len(s)] = a + len(s)
    sa, rank = suffixdedup.suffix_array(text, end, 64)
    suffixes = [bytes(text[i:end[i]]) for i in sa]
    assert suffixes == sorted(suffixes) and len(sa) == sum(map(len, strings))
    assert all((rank[a] == rank[b]) == (x == y) for a, b, x, y in zip(sa, sa[1:], suffixes, suffixes[1:]))

    def common(x, y):
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return n

    assert suffixdedup.common_prefixes(text, end, first, sa, 64).tolist() == [0] + [
        common(x, y) for x, y in zip(suffixes, suffixes[1:])]


@pytest.mark.parametrize("spread", [False, True])
def test_windows_that_share_more_than_the_first_doublings(spread):
    """Windows of 656 bytes that share 448 to 600 and differ behind them, in
    both orders: only strings found in two windows repeat."""
    rng, length = random.Random(11), 400
    some = lambda n: bytes(rng.choices(range(97, 101), k=n))
    windows = []
    for _ in range(150):
        shared = some(rng.randrange(448, 600))
        tails = [some(1), some(1)]
        for lead in rng.sample(range(0, 656 - len(shared)), 2):
            windows.append(some(lead) + shared + tails.pop() + some(655 - lead - len(shared)))
    places = {}
    for k, w in enumerate(windows):
        for i in range(len(w) - length + 1):
            places.setdefault(w[i:i + length], []).append((k, i))
    want = sorted(p for own in places.values() if len(own) > 1 for p in own)
    ones = np.ones(len(windows), dtype=np.int64)
    (window, start), (run_window, run_start, repeated) = suffixdedup.shard_repeats(
        windows, ones, np.full(len(windows), spread), length)
    assert sorted(zip(window.tolist(), start.tolist())) == want
    runs = {windows[w][x:x + length]: bool(r) for w, x, r in zip(run_window, run_start, repeated)}
    assert runs == ({s: len(own) > 1 for s, own in places.items()} if spread else {})
    assert len(run_window) == len(runs)


@given(st.binary(max_size=300).map(lambda b: bytes(x % 2 for x in b)))
@settings(max_examples=100, deadline=None)
def test_home_windows_cover_every_start_once(data):
    covered = [s for _, _, lo, size in suffixdedup.home_windows(data, 32) for s in range(lo, lo + size)]
    assert covered == list(range(max(0, len(data) - 31)))


# ---- lines ------------------------------------------------------------------------

LINES = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb", None, "", "\n\n\n\n", " \n\n \n", "a\na\na\na\na\na", "q\na\na\na\nr",
         "a\nb\nc\nd", "p\r\nq\nr\n", "p\r\nq\nr\n", "c\nd\na\nb\nc\nd\ne", "\n".join(f"l{i % 50}" for i in range(5000))]


def test_line_dedup_matches_sql_on_cases(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(LINES)))
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_removed, n_spans, kept_sha256 FROM ({linededup.ORACLE})").fetchall())
    rows = linededup.dedup_lines(frame(spark, LINES))
    got = sorted((r["doc_id"], r["n_lines"], r["n_removed"], r["n_spans"],
                  hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows.collect())
    assert got == want
    assert rows.columns == ["doc_id", "text", "row", "key", "windows", "n_lines", "n_removed", "n_spans"]
    assert got[0][2] == 0 and got[9][2] == 4


def test_line_dedup_of_equal_rows_and_no_rows(spark):
    rows = linededup.dedup_lines(frame(spark, ["a\nb\nc"] * 3, [1, 1, 1])).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 3, 3]
    assert linededup.dedup_lines(frame(spark, [])).collect() == []


# ---- SimHash ------------------------------------------------------------------------

def brute_fingerprint(text, k=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(values, max_bits):
    """``root[i]``: least index reachable over links of ``max_bits`` or fewer bits."""
    root, a = list(range(len(values))), np.array(values, dtype=np.uint64)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= max_bits):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def test_simhash_of_the_whole_table(spark):
    texts = dict(sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()))
    fps, ids = [brute_fingerprint(t) for t in texts.values()], list(texts)
    want = {d: (f"{f:016x}", ids[r]) for d, f, r in zip(ids, fps, brute_components(fps, 4))}
    got = {r[0]: tuple(r)[1:] for r in registry.QUERIES["op9_simhash_near_dedup"](spark, SF0001).collect()}
    assert got == want


@pytest.mark.parametrize("text", ["", " \t", "One", "A b\x0bC d E É", "É é", "a\x1cb c", "w " * 3000, "x y z w " * 70000])
def test_fingerprint_cases(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("max_bits", [1, 4, 7])
def test_near_links_lose_no_class(spark, monkeypatch, max_bits):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # long posting lists are posted anew, down to half bytes
    rng = random.Random(max_bits)
    values = [rng.getrandbits(64) for _ in range(8)]
    for v in list(values):
        for _ in range(40):
            for b in rng.sample(range(64), rng.randrange(1, max_bits + 3)):
                v ^= 1 << b  # chains
            values.append(v)
    values = sorted(set(values) | {0, 1, (1 << 64) - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), max_bits)
    assert all(bin((r["u"] ^ r["v"]) & (1 << 64) - 1).count("1") <= max_bits for r in links.collect())
    roots = {r["node"]: r["root"] for r in components.component_roots(links).collect()}
    parts = {}
    for v, r in zip(signed, brute_components(values, max_bits)):
        parts.setdefault(r, []).append(v)
    assert sorted(sorted(p) for p in parts.values() if len(p) > 1) == sorted(
        sorted(k for k, x in roots.items() if x == r) for r in set(roots.values()))


@pytest.mark.parametrize("max_bits", [1, 4, 7])
def test_every_link_meets_at_every_level_of_postings(max_bits):
    rng = random.Random(max_bits)
    first, *finer = simhash.posting_masks(max_bits)
    for _ in range(200):
        gone = 0
        for b in rng.sample(range(64), max_bits):
            gone |= 1 << b
        masks = {m for m in first if not m & gone}
        assert masks
        for after in finer:
            # Whichever lists were long: some list of the pair leads on to a common one.
            masks = {n for m in masks for n in after[m] if not n & gone}
            assert masks


def test_long_lists_lose_no_pair(spark, monkeypatch):
    # All share the first three bytes and most the first four: only half bytes split them.
    rng = random.Random(3)
    values = sorted({(rng.getrandbits(16) << 32) | (rng.getrandbits(2) << 24) | 0xABCDEF for _ in range(300)})
    monkeypatch.setattr(simhash, "BLOCK", 4)
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), 4)
    roots = {r["node"]: r["root"] for r in components.component_roots(links).collect()}
    assert [roots.get(v, v) for v in values] == [values[r] for r in brute_components(values, 4)]


def test_the_tally_rejects_pairs():
    # One byte in five positions differs by one bit: three shared bytes meet in a list, four are guaranteed.
    a, b = np.uint64(0), np.uint64(0x0101010101000000)
    c = np.uint64(0x0000000101000000)
    assert simhash.tally(np.array([a, b, c]), a).tolist() == [8, 3, 6]
    assert simhash.spanning_links(np.array([a, b]), 4, 4) == []
    # The bits alone would link them at five: the tally is what drops the pair.
    assert simhash.spanning_links(np.array([a, b]), 5, 4) == []
    assert simhash.spanning_links(np.array([a, c]), 4, 4) == [(0, 1)]


CLASHES = ["runs", "_row", "row", "id", "cut", "_cut", "doc", "line", "_lines", "n_lines", "n_removed", "N_SPANS",
           "_place", "place", "_nth", "nth", "root", "text_key", "fp", "k", "a.b", "first"]


def test_columns_with_internal_names_pass_through(spark):
    text = "\n".join(f"shared line {i} of the passage" for i in range(6))
    rows = [(i, t, *(f"{c}{i}" for c in CLASHES)) for i, t in enumerate([text, text + "\nown", "lonely words", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    cut = linededup.dedup_lines(df)
    counts = linededup.count_columns(df)
    assert counts == ["_n_lines", "_n_removed", "_n_spans"]
    assert cut.columns == [*df.columns, *counts]
    got = {r[0]: tuple(r) for r in cut.collect()}
    assert {k: (*v[:1], *v[2:-3]) for k, v in got.items()} == {r[0]: (*r[:1], *r[2:]) for r in rows}
    assert got[0][1] == text and got[1][1] == "own" and got[1][-3:] == (7, 6, 1) and got[3][1] == ""
    kept = simhash.keep_one(df, simhash.near_duplicates(df))
    assert kept.columns == df.columns
    assert set(map(tuple, kept.collect())) <= set(rows)


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, k) for k in range(101, 160)] + [(99, 150)]
    links = spark.createDataFrame([(v, u) if u % 2 else (u, v) for u, v in path + star], "u long, v long")
    got = {r["node"]: r["root"] for r in components.component_roots(links).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 99 for i in range(99, 160)}
    assert components.component_roots(links.limit(0)).collect() == []


def test_simhash_cases_and_keep_one(spark):
    texts = ["one two three four five six seven", "One Two Three Four Five Six Seven", None, "", " ", "lonely words here",
             "one two three four five six seven", "one two three four five six seven"]
    df = frame(spark, texts, [3, 2, 9, 8, 8, None, 2, 2])
    found = simhash.near_duplicates(df)
    assert sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=repr) == sorted(
        [(3, 2), (2, 2), (9, 8), (8, 8), (8, 8), (None, None), (2, 2), (2, 2)], key=repr)
    kept = simhash.keep_one(df, found)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [2, 8, None]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


# ---- decontamination -----------------------------------------------------------------

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items):
    windows = {}
    for i, t in items:
        w = brute_words(t)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + min(10, len(w))]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = brute_words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k:k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def test_contamination_of_the_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = [tuple(r) for r in registry.QUERIES["op10_benchmark_decontamination"](spark, SF001).collect()]
    assert sorted(got, key=repr) == brute_contamination(docs, items)
    assert any(r[-1] for r in got)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs far away"), (2, "short item"), (3, "Solo"), (4, None),
         (5, "!!!"), (6, "a a a a a a a a a a a a"), (7, "ÉCOLE é ÀB cd"), (1, "short ITEM"), (None, "no id here now ok"),
         (8, "one two three four five six seven eight nine ten")]
TEXTS = [None, "", "x the QUICK brown-fox jumps over the lazy dog and runs far", "short, item; solo.", "a " * 40,
         "École é Àb CD", "École é Àb CD ", "ÉCOLE é ÀB cd", "one two three four five six seven eight nine", "shortitem",
         "one two three four five six seven eight nine ten " * 3, "no id here now ok", "SOLO " * 20000, "a a a a a a a a a"]


@pytest.mark.parametrize("bound", [decontaminate.SHINGLE_BYTES, 0])
def test_contamination_cases(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "SHINGLE_BYTES", bound)
    items = spark.createDataFrame([(i, t, 0, "x") for i, t in ITEMS], "item_id long, text string, row long, w string")
    df = frame(spark, TEXTS + TEXTS[2:4], [*range(len(TEXTS)), 2, None])
    found = decontaminate.report(*decontaminate.contamination(df, items))
    got = sorted(((r["id"], r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                   r["contaminated"]) for r in found.collect()), key=repr)
    assert got == brute_contamination([*enumerate(TEXTS), (2, TEXTS[2]), (None, TEXTS[3])], ITEMS)
    kept = decontaminate.drop_contaminated(df, items)
    assert kept.columns == df.columns
    clean = [r[0] for r in brute_contamination([*enumerate(TEXTS), (2, TEXTS[2]), (None, TEXTS[3])], ITEMS) if not r[-1]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == clean


def test_contamination_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = frame(spark, ["some text", None])
    none = decontaminate.report(*decontaminate.contamination(df, items.limit(0))).collect()
    assert sorted((r["id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in none) == [(0, 2, 0, False), (1, 0, 0, False)]
    assert decontaminate.report(*decontaminate.contamination(df.limit(0), items)).collect() == []


def test_decontamination_is_native(spark):
    plan = registry.QUERIES["op10_benchmark_decontamination"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ---- SQL agreement ---------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    got = registry.QUERIES[name](spark, SF0001)
    cur = con.execute(registry.ORACLES[name])
    names, want = [d[0] for d in cur.description], cur.fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(names) == sorted(got.columns) and len(rows) == len(want)
    assert digest(got.columns, rows) == digest(names, want)
