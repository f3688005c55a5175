"""Packing and the pipeline against brute force."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from conftest import SF001, SF0001
from corpusml.llm import decontaminate, linededup, packing, registry, simhash, toxicity

DOCS = "doc_id long, text string, length string, part string"


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def check_packing(rows, texts, tokenizer, capacity):
    """Every piece is the right part of its document, sequences are gapless
    and hold at most ``capacity`` ids."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = tokenizer(text), 0
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        if len(ids) <= capacity:
            assert len(pieces) == 1
        for r in pieces:
            own = np.array(ids[at:at + r["length"]], dtype="<u4")
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(own.tobytes())
            assert r["piece"] == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids)
    place = {}
    for r in rows:
        place.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in place.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(place)


def test_packing_of_the_whole_table(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = registry.QUERIES["op1_best_fit_packing"](spark, SF001).collect()
    n = check_packing(rows, texts, tokenizer, packing.CAPACITY)
    bound = -(-sum(r["length"] for r in rows) // packing.CAPACITY)
    assert n <= bound * 1.01 + 1


def test_packing_cases(spark, tokenizer):
    texts = {1: None, 2: "", 3: "a", 4: "word " * 30000, 5: "a", 6: "<|endoftext|> é🙂", 7: "x" * 20000}
    df = spark.createDataFrame([(k, v, "x", "y") for k, v in texts.items()], DOCS)
    check_packing(packing.pack_documents(df, capacity=64).collect(), texts, tokenizer, 64)
    repeated = packing.pack_documents(df.where("doc_id = 3").union(df.where("doc_id = 3"))).collect()
    assert sorted((r["sequence_id"], r["offset"], r["length"]) for r in repeated) == [(0, 0, 2), (0, 2, 2)]
    assert packing.pack_documents(df.limit(0)).collect() == []
    with_ids = packing.pack_documents(df, capacity=64, keep_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in with_ids)


def test_ids_are_the_tokenizers_ids_on_odd_texts(tokenizer):
    rng = np.random.default_rng(5)
    code_points = np.concatenate([np.arange(9, 14), np.arange(28, 127), np.arange(160, 0x3000, 7),
                                  np.arange(0x1F300, 0x1F640), [0x3000, 0x200B, 0xFFFD, 0x10FFFF]])
    texts = ["".join(map(chr, rng.choice(code_points, 4000))) for _ in range(20)]
    texts += [" " * 50000, "\n" * 30000, "x" * 50000, "\u6f22\u5b57" * 20000, "1234567890" * 3000, "don't I'LL we've  \t\n x",
              "<|endoftext|>", "\x00\x01", "".join(rng.choice(list("abcdefgh"), 50000))]
    bpe = packing.byte_bpe(packing.vocabulary_path())
    assert all([*bpe.encode_ordinary(t), packing.SEPARATOR_ID] == tokenizer(t) for t in texts)


def test_long_runs_of_white_space(spark, tokenizer):
    n = 1_200_000
    texts = [" " * n, "\n" * n, "a" + " " * n + "b", "a b" + "\n" * n + "\u6f22", " \t" * (n // 2) + "7",
             "a" + "\r\n" * (n // 2) + " c" + "\u3000" * 70000 + ".", "x " * 40000 + " " * packing.LONG_SPACE + "y"]
    for edge in (packing.LONG_SPACE - 1, packing.LONG_SPACE, packing.LONG_SPACE + 1):
        texts += ["a" + " " * edge, " " * edge + "'s a", "1" + "\n" * edge + "  b", "a" + " " * edge + "\x1c" + " " * edge]
    bpe = packing.byte_bpe(packing.vocabulary_path())
    assert all([*packing.encode_text(bpe, t), packing.SEPARATOR_ID] == tokenizer(t) for t in texts)
    two = dict(enumerate(texts[1:3]))
    df = spark.createDataFrame([(k, v, "x", "y") for k, v in two.items()], DOCS)
    check_packing(packing.pack_documents(df).collect(), two, tokenizer, packing.CAPACITY)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=150, deadline=None)
def test_plan_uses_the_histogram_once_and_fits(lengths):
    histogram = Counter(lengths)
    plan = packing.packing_plan(dict(histogram), 40)
    used = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 40 and times > 0
        for x in pattern:
            used[x] += times
    assert used == histogram


def brute_complements(length, gap, free):
    """All ways to fill ``gap`` beside one ``length`` with one to three lengths up to it."""
    own = Counter({x: n for x, n in enumerate(free.tolist()) if n and x <= length})
    own[length] -= 1
    return [c for k in (1, 2, 3) for c in itertools.combinations_with_replacement(sorted(own, reverse=True), k)
            if sum(c) == gap and all(own[x] >= n for x, n in Counter(c).items())]


@pytest.mark.parametrize("seed", range(40))
def test_sum_index_finds_what_brute_force_finds(seed):
    rng = random.Random(seed)
    capacity = rng.choice([12, 24, 40])
    free = np.zeros(capacity + 1, dtype=np.int64)
    for x in rng.sample(range(1, capacity), rng.randrange(1, 11)):
        free[x] = rng.choice([1, 1, 2, 5])
    index = packing.SumIndex(free)
    for length in range(capacity - 1, 0, -1):
        while free[length]:
            want = brute_complements(length, capacity - length, free)
            found = index.complement(length, capacity - length)
            assert found == (want[0] if want else None)
            if not found:
                break
            for x in (length, *found):
                free[x] -= 1
                assert free[x] >= 0


def fewest_sequences(lengths, capacity):
    """Exact minimum by search over the open gaps."""
    best = len(lengths)

    def place(at, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if at == len(lengths):
            best = len(gaps)
            return
        for gap in {g for g in gaps if g >= lengths[at]}:
            rest = list(gaps)
            rest.remove(gap)
            place(at + 1, [*rest, gap - lengths[at]])
        place(at + 1, [*gaps, capacity - lengths[at]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_near_the_brute_force_minimum(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randrange(1, 21) for _ in range(9)), reverse=True)
    used = sum(times for _, times in packing.packing_plan(dict(Counter(lengths)), 20))
    least = fewest_sequences(lengths, 20)
    assert least <= used <= least + 1


def test_exact_complements_come_first():
    plan = packing.packing_plan({30: 2, 10: 2, 20: 1, 15: 1, 5: 1, 25: 1}, 40)
    assert sum(n for _, n in plan) == 4  # 145 ids: four sequences of 40 are the least
    assert ((30, 10), 2) in plan
    assert packing.packing_plan({25: 1, 10: 1, 5: 1}, 40) == [((25, 10, 5), 1)]
    assert packing.packing_plan({22: 1, 9: 1, 6: 1, 3: 1}, 40) == [((22, 9, 6, 3), 1)]


# ---- pipeline -----------------------------------------------------------------

def test_pipeline_stages_act_on_their_input(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns = docs.columns
    kept = {r["doc_id"]: r for r in corpus_pipeline.drop_toxic(spark, docs, SF0001).collect()}
    scored = {r["doc_id"]: r["predicted"] for r in registry.QUERIES["op4_toxicity"](spark, SF0001).collect()}
    assert set(kept) == {d for d, p in scored.items() if p == 0}

    cut = corpus_pipeline.cut_repeated_lines(spark, docs, SF0001)
    assert cut.columns == columns
    report = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    got = {r["doc_id"]: r for r in cut.collect()}
    assert set(got) == {d for d, r in report.items() if r["n_removed"] < r["n_lines"]}
    assert all(r["text"] == report[d]["text"] for d, r in got.items())
    assert all(r["n_chars"] == len(r["text"]) for d, r in got.items() if report[d]["n_removed"])

    one = corpus_pipeline.drop_near_duplicates(spark, docs, SF0001)
    assert one.columns == columns
    classes = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(classes)

    clean = corpus_pipeline.drop_contaminated(spark, docs, SF0001)
    assert clean.columns == columns
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    bad = {r["id"] for r in decontaminate.report(*decontaminate.contamination(docs, items)).collect()
           if r["contaminated"]}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - bad


def test_pipeline_runs_all_stages_in_order(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "drop_toxic", "cut_repeated_lines", "drop_near_duplicates", "drop_contaminated", "pack"]
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF0001).collect(), docs.schema)
    packed = corpus_pipeline.run(spark, SF0001).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_on_odd_documents(spark):
    schema = spark.read.parquet(f"{SF0001}/documents.parquet").schema
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c d e", "en", "s", 9),
            (2, "", "en", "s", 0), (3, "a\nb\nc\nd", "en", "s", 7), (4, "a\nb\nc\ne", "en", "s", 7),
            (5, "a\nb\nc", "en", "s", 5), (6, "w " * 40000, "en", "s", 80000)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF0001)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        corpus_pipeline.pack(spark, docs, SF0001).collect()


# ---- toxicity -----------------------------------------------------------------

def test_toxicity_separates_held_out_rows(spark):
    scored = registry.QUERIES["op4_toxicity"](spark, SF001)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = scored.collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.75
    assert np.mean([s >= 0.7 for s in neg]) < 0.1


def test_toxicity_learns_words_and_parts_of_words(spark):
    rng = np.random.default_rng(3)
    plain = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "theta"]

    def text(bad, n=60):
        words = list(rng.choice(plain, n))
        if bad:
            words[int(rng.integers(n))] = bad
        return " ".join(words)

    rows = [(i, text(("zorgle", f"qxvet{'abcdefgh'[i % 8] * 3}")[i % 2] if i % 3 == 0 else None)) for i in range(240)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(0, 0), (None, 1), (999, 1), (1, None)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(docs.drop("toxic"), labels)
    long_text = text(None, 3000) + " zorgle " + text(None, 500)
    bad = toxicity.score_texts(model, ["zorgle", text("zorgle"), text("qxvetnew"), long_text])
    good = toxicity.score_texts(model, ["", text(None), text(None, 4000), "x" * 100000])
    assert bad.min() > 0.7 > 0.5 > good.max()


def test_toxicity_gradient_matches_differences():
    """The hand-written backward pass against finite differences of a GRU."""
    rng = np.random.default_rng(0)
    h = toxicity.HIDDEN
    x = rng.normal(size=(5, 3, 3 * h)).astype(np.float32)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], dtype=bool)
    u, target = rng.normal(0, 0.4, (h, 3 * h)).astype(np.float32), rng.normal(size=(5, 3, h)).astype(np.float32)
    kept: list = []
    toxicity._gru(x, mask, u, range(5), kept)
    dx, du = toxicity._gru_gradient(kept, mask, u, target)
    loss = lambda a, b: float((toxicity._gru(a, mask, b, range(5)).astype(np.float64) * target).sum())
    for at in [(0, 0, 1), (1, 2, h + 2), (2, 1, 2 * h + 3), (3, 0, 5)]:
        step = np.zeros_like(x)
        step[at] = 1e-2
        assert abs((loss(x + step, u) - loss(x - step, u)) / 2e-2 - dx[at]) < 2e-2
    for at in [(0, 0), (3, h + 1), (5, 2 * h + 4)]:
        step = np.zeros_like(u)
        step[at] = 1e-2
        assert abs((loss(x, u + step) - loss(x, u - step)) / 2e-2 - du[at]) < 2e-2


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_texts(toxicity.fit(docs, none), ["a", ""]).tolist() == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score_texts(toxicity.fit(docs, one), ["a"]).tolist() == [1.0]
