"""Toxicity scores from a bidirectional GRU with attention pooling.

A text is read as windows of ``WINDOW`` words, every half window a new one
(the windows overlap and cover the whole text); the text's score is that of
its worst window.  A word enters the network as

* word inputs: its hashed identity's log-odds and a trained embedding;
* character inputs: mean and maximum of the log-odds of its hashed byte
  3-grams and 4-grams, so parts of unseen words speak too.

Training is numpy on the driver over a bounded sample of labelled rows: at
most ``ROWS_PER_CLASS`` rows of each class, chosen by a hash of the id.
Document counts of words and grams over this sample give the log-odds;
the sample's windows with the most evidence (and two others of each
negative text) train the network; positive texts without any evidence would
only teach it noise and are left out.  Scoring is a pandas UDF over all rows;
the model is a few megabytes whatever the data size.

Defined cases: null text is an empty text; a text without words is one
empty window, which the network learns as not toxic; labels of null or unknown ids are
ignored, of repeated labels the highest counts; without both classes in
the sample every score is the share of positive rows (0 without rows);
words over ``LONGEST`` bytes continue as further words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import materialize, text_or_empty

ROWS_PER_CLASS = 3000
WINDOW, STRIDE = 32, 16
LONGEST = 64
WORD_BITS, GRAM_BITS = 17, 16
GRAMS = (3, 4)
EMBEDDING, HIDDEN = 4, 8
#: Texts in which a word or gram must occur before it has log-odds or an embedding.
SUPPORT = 5
#: Standard errors by which log-odds are drawn towards 0.
DOUBT = 1.64
EPOCHS, BATCH, RATE = 6, 128, 0.01
BATCH_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_PRIME = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_PRIME, k + 1, 1 << 64) for k in range(LONGEST)], dtype=np.uint64)


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class Words:
    """The words of some texts: ``doc`` (index of the text), ``word`` bucket,
    and for each gram size the buckets of all grams with the first gram and
    the number of grams of each word; ``start``/``end`` are byte places."""
    doc: np.ndarray
    word: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    start: np.ndarray
    end: np.ndarray
    data: bytes


def read_words(texts: list[str]) -> Words:
    encoded = [t.encode() for t in texts]
    data = b"\n".join(encoded) + b"\n"
    low = _LOWER[np.frombuffer(data, dtype=np.uint8)]
    inside = _WORD[low]
    step = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = -(-(end - start) // LONGEST)
    if len(cuts) and cuts.max() > 1:
        part = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        start, end = np.repeat(start, cuts) + part * LONGEST, np.repeat(end, cuts)
        end = np.minimum(end, start + LONGEST)
    size = end - start
    first = np.cumsum(size) - size
    doc = np.searchsorted(np.cumsum([len(e) + 1 for e in encoded]), start, side="right").astype(np.int32)
    c = low[inside].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(c)) - np.repeat(first, size)
    if not len(start):
        none = np.zeros(0, dtype=np.int32)
        return Words(doc, none, [(none, none, none) for _ in GRAMS], start, end, data)
    word = _bucket(np.add.reduceat(c * _POWERS[place], first), WORD_BITS)
    left = np.repeat(size, size) - place
    grams = []
    for n in GRAMS:
        h = np.zeros(len(c), dtype=np.uint64)
        for k in range(n):
            h[:max(len(c) - k, 0)] += c[k:] * _POWERS[k]
        count = np.maximum(size - n + 1, 0)
        grams.append((_bucket(h[left >= n], GRAM_BITS), np.cumsum(count) - count, count))
    return Words(doc, word, grams, start, end, data)


@dataclass
class Model:
    """Log-odds tables, embeddings and network weights."""
    bias_only: float | None = None
    word_odds: np.ndarray = field(default_factory=lambda: np.zeros(1 << WORD_BITS, np.float32))
    known: np.ndarray = field(default_factory=lambda: np.zeros(1 << WORD_BITS, bool))
    gram_odds: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1 << GRAM_BITS, np.float32) for _ in GRAMS])
    weights: dict[str, np.ndarray] = field(default_factory=dict)


def fixed_inputs(model: Model, words: Words) -> np.ndarray:
    """``(words, 1 + 2 * len(GRAMS))``: log-odds inputs of every word."""
    out = np.zeros((len(words.word), 1 + 2 * len(GRAMS)), dtype=np.float32)
    out[:, 0] = model.word_odds[words.word]
    for k, (ids, first, count) in enumerate(words.grams):
        some = count > 0
        if some.any():
            odds, at = model.gram_odds[k][ids], first[some]
            out[some, 1 + 2 * k] = np.add.reduceat(odds, at) / count[some]
            out[some, 2 + 2 * k] = np.maximum.reduceat(odds, at)
    return out


def window_table(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, first word, number of words)`` of all windows: every half
    window a new one, until the text's end is covered; one for each text."""
    size = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(size) - size
    windows = 1 + -(-np.maximum(size - WINDOW, 0) // STRIDE)
    owner = np.repeat(np.arange(n_docs), windows)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
    n = np.minimum(size[owner] - offset, WINDOW)
    return owner, np.stack([first[owner] + offset, n], axis=1)


def _steps(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word index and mask of every step, time first."""
    t = np.arange(WINDOW)[:, None]
    mask = t < windows[:, 1]
    return np.where(mask, windows[:, 0] + t, 0), mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _gru(x: np.ndarray, mask: np.ndarray, u: np.ndarray, order: range, keep: list | None = None) -> np.ndarray:
    """States (time, batch, hidden) for projected inputs ``x``."""
    h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
    out = np.empty((x.shape[0], *h.shape), dtype=np.float32)
    for t in order:
        g = h @ u
        gates = _sigmoid(x[t, :, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(x[t, :, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        if keep is not None:
            keep.append((t, h, z, r, new, g[:, 2 * HIDDEN:]))
        h = np.where(mask[t][:, None], new + z * (h - new), h)
        out[t] = h
    return out


def _attend(states: np.ndarray, mask: np.ndarray, w: dict[str, np.ndarray]):
    s = np.where(mask, states @ w["v"], np.float32(-1e9))
    a = np.exp(s - s.max(axis=0)) * mask
    a /= np.maximum(a.sum(axis=0), np.float32(1e-9))
    pooled = np.einsum("tb,tbh->bh", a, states)
    return a, pooled, pooled @ w["o"] + w["c"]


def window_scores(model: Model, inputs: np.ndarray, word: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Toxicity of each window (0 to 1)."""
    w = model.weights
    x = np.concatenate([inputs, w["emb"][np.where(model.known[word], word, 0)]], axis=1)
    if not len(x):
        x = np.zeros((1, x.shape[1]), dtype=np.float32)
    forth, back = x @ w["wf"] + w["bf"], x @ w["wb"] + w["bb"]
    out = np.empty(len(windows), dtype=np.float32)
    for k in range(0, len(windows), 1024):
        at, mask = _steps(windows[k:k + 1024])
        states = np.concatenate([_gru(forth[at], mask, w["uf"], range(WINDOW)),
                                 _gru(back[at], mask, w["ub"], range(WINDOW - 1, -1, -1))], axis=2)
        out[k:k + 1024] = _sigmoid(_attend(states, mask, w)[2])
    return out


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """Score of each text: its worst window's."""
    if model.bias_only is not None:
        return np.full(len(texts), model.bias_only)
    out, i = np.zeros(len(texts)), 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BATCH_BYTES):
            size += len(texts[j])
            j += 1
        words = read_words(texts[i:j])
        owner, windows = window_table(words.doc, j - i)
        scores = window_scores(model, fixed_inputs(model, words), words.word, windows)
        np.maximum.at(out, owner + i, scores)
        i = j
    return out


def _gru_gradient(kept: list, mask: np.ndarray, u: np.ndarray, d_out: np.ndarray):
    """Gradients of the projected inputs and of ``u``."""
    dx = np.zeros((*d_out.shape[:2], 3 * HIDDEN), dtype=np.float32)
    du, dh = np.zeros_like(u), np.zeros(d_out.shape[1:], dtype=np.float32)
    for t, h, z, r, new, gn in reversed(kept):
        dh = dh + d_out[t]
        m = mask[t][:, None]
        d = dh * m
        d_new = d * (1 - z) * (1 - new * new)
        dg = np.concatenate([d * (h - new) * z * (1 - z), d_new * gn * r * (1 - r), d_new * r], axis=1)
        dx[t] = np.concatenate([dg[:, :2 * HIDDEN], d_new], axis=1)
        du += h.T @ dg
        dh = dh * ~m + d * z + dg @ u.T
    return dx, du


def train(model: Model, texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit embeddings and network to labelled window texts."""
    rng = np.random.default_rng(seed)
    words = read_words(texts)
    fixed = fixed_inputs(model, words)
    size = np.bincount(words.doc, minlength=len(texts))
    windows = np.stack([np.cumsum(size) - size, np.minimum(size, WINDOW)], axis=1)
    word = np.where(model.known[words.word], words.word, 0)
    used, local = np.unique(word, return_inverse=True)  # the rows of the embedding that occur here
    dims = fixed.shape[1] + EMBEDDING
    w = {"emb": rng.normal(0, 0.05, (len(used), EMBEDDING)), "c": np.zeros(())}
    for side in "fb":
        w |= {f"w{side}": rng.normal(0, dims ** -0.5, (dims, 3 * HIDDEN)), f"b{side}": np.zeros(3 * HIDDEN),
              f"u{side}": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN))}
    w |= {"v": rng.normal(0, 0.3, 2 * HIDDEN), "o": rng.normal(0, 0.3, 2 * HIDDEN)}
    w = {k: np.asarray(v, dtype=np.float32) for k, v in w.items()}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    y = labels.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    batches = max(1, -(-len(texts) // BATCH))
    epochs = max(EPOCHS, -(-300 // batches))  # small samples: at least 300 steps
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for own in np.array_split(order, batches):
            at, mask = _steps(windows[own])
            x = np.concatenate([fixed[at], w["emb"][local[at]]], axis=2) if len(fixed) else \
                np.zeros((*at.shape, dims), dtype=np.float32)
            kept: dict[str, list] = {"f": [], "b": []}
            states = np.concatenate([
                _gru(x @ w["wf"] + w["bf"], mask, w["uf"], range(WINDOW), kept["f"]),
                _gru(x @ w["wb"] + w["bb"], mask, w["ub"], range(WINDOW - 1, -1, -1), kept["b"])], axis=2)
            a, pooled, logit = _attend(states, mask, w)
            d_logit = (_sigmoid(logit) - y[own]) * weight[own] / len(own)
            d_pooled = d_logit[:, None] * w["o"]
            da = np.einsum("bh,tbh->tb", d_pooled, states)
            ds = a * (da - (a * da).sum(axis=0))
            d_states = a[..., None] * d_pooled + ds[..., None] * w["v"]
            grad = {"o": pooled.T @ d_logit, "c": d_logit.sum(), "v": np.einsum("tb,tbh->h", ds, states)}
            d_x = 0
            for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
                dp, grad[f"u{side}"] = _gru_gradient(kept[side], mask, w[f"u{side}"], d_states[..., part])
                grad[f"w{side}"] = np.einsum("tbd,tbh->dh", x, dp, optimize=True)
                grad[f"b{side}"] = dp.sum(axis=(0, 1))
                d_x = d_x + dp @ w[f"w{side}"].T
            grad["emb"] = np.zeros_like(w["emb"])
            if len(fixed):
                np.add.at(grad["emb"], local[at][mask], d_x[mask][:, -EMBEDDING:])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for k, g in grad.items():  # Adam with gradients of norm 1 at most
                g = np.asarray(g / max(1.0, norm), dtype=np.float32)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = (w[k] - RATE * (first[k] / (1 - 0.9 ** step))
                        / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    table = np.zeros((1 << WORD_BITS, EMBEDDING), dtype=np.float32)
    table[used] = w["emb"]
    model.weights = w | {"emb": table}
    return model


def _log_odds(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Log-odds, drawn towards 0 by ``DOUBT`` standard errors and scaled."""
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    sure = np.maximum(np.abs(odds) - DOUBT * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5)), 0)
    return np.where(pos + neg >= SUPPORT, np.sign(odds) * np.minimum(sure, 6) / 2, 0).astype(np.float32)


def _document_counts(sample: DataFrame) -> DataFrame:
    """``[kind, bucket, pos, neg]``: texts with each word (kind 0) or gram
    bucket, by class; partial counts of a task are one table."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = [1 << WORD_BITS] + [1 << GRAM_BITS] * len(GRAMS)
        tables = [np.zeros((2, n), dtype=np.int64) for n in sizes]
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words = read_words([text])
                for table, ids in zip(tables, [words.word] + [g[0] for g in words.grams], strict=True):
                    table[int(toxic > 0), np.unique(ids)] += 1
        for kind, table in enumerate(tables):
            own = np.flatnonzero(table.sum(axis=0))
            yield pd.DataFrame({"kind": kind, "bucket": own, "neg": table[0, own], "pos": table[1, own]})

    parts = sample.mapInPandas(count, "kind int, bucket long, neg long, pos long")
    return parts.groupBy("kind", "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _training_windows(sample: DataFrame, model: Model) -> DataFrame:
    """``[text, toxic]``: of positive texts the window with the most
    evidence, of negative ones the two with the most and two by a hash."""
    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words = read_words([text])
                _, windows = window_table(words.doc, 1)
                proof = np.concatenate([[0], np.cumsum(np.maximum(fixed_inputs(model, words), 0).sum(axis=1))])
                best = np.argsort(proof[windows[:, 0]] - proof[windows.sum(axis=1)], kind="stable")
                chosen = {int(best[0])}
                if toxic > 0 and not proof[-1]:
                    continue  # nothing here tells it from other texts
                if toxic <= 0:
                    chosen |= {int(k) for k in best[:2]} | {(len(text) * k) % len(windows) for k in (31, 77)}
                for k in sorted(chosen):
                    a, n = windows[k]
                    own = [words.data[s:e].decode(errors="replace")
                           for s, e in zip(words.start[a:a + n], words.end[a:a + n], strict=True)]
                    rows.append((" ".join(own), int(toxic > 0)))
            yield pd.DataFrame(rows, columns=["text", "toxic"])

    return sample.mapInPandas(choose, "text string, toxic int")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Train on at most ``rows_per_class`` labelled rows of each class."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic"))
    by_hash = [F.xxhash64(id_col), F.col(id_col)]
    parts = [known.where(c).orderBy(*by_hash).limit(rows_per_class) for c in ("toxic > 0", "toxic <= 0")]
    # At most twice rows_per_class ids: a proven bound.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))
    sample = materialize(texts.join(chosen, id_col).dropDuplicates([id_col]).select("text", "toxic"), "sample")
    classes = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = classes.get(True, 0), classes.get(False, 0)
    if not n_pos or not n_neg:
        return Model(bias_only=n_pos / max(1, n_pos + n_neg))
    model = Model()
    counts = _document_counts(sample).toPandas()  # at most the hash tables' sizes
    for kind in range(1 + len(GRAMS)):
        own = counts[counts.kind == kind]
        pos, neg = np.zeros((2, 1 << (GRAM_BITS if kind else WORD_BITS)))
        pos[own.bucket], neg[own.bucket] = own.pos, own.neg
        odds = _log_odds(pos, neg, n_pos, n_neg)
        if kind:
            model.gram_odds[kind - 1] = odds
        else:
            model.word_odds, model.known = odds, pos + neg >= SUPPORT
    chosen_windows = _training_windows(sample, model).toPandas()  # at most 1 + 4 windows for each pair of rows
    chosen_windows = chosen_windows.sort_values(["text", "toxic"], kind="stable")
    # Nothing said is nothing toxic: empty windows among the negative ones.
    empty = [""] * (1 + int((chosen_windows.toxic == 0).sum()) // 50)
    return train(model, [*chosen_windows.text, *empty],
                 np.append(chosen_windows.toxic.to_numpy(), np.zeros(len(empty))))


def score_column(spark, model: Model, text_col: str = "text") -> Column:
    """Toxicity score (0 to 1) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_texts(shared.value, texts.tolist()))

    return score(text_or_empty(text_col))
