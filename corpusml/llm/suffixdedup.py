"""Repeated byte strings by per-shard suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else (same document included) is removed.

*Home windows.*  For a start ``i`` the least 8-byte hash among the next few
hundred bytes marks its anchor; the choice depends on the string alone, so
equal strings have anchors at equal distances.  Starts with one anchor are
neighbours; together with their strings they form a window, known by the
bytes behind the anchor (``k``) and by its whole content (``d``).  A string
can repeat only if its ``k`` does, so one pass over the texts and a count of
``k`` leave the windows worth sorting.  Equal windows are aggregated to one
with a count before anything is shuffled further.

*Shards.*  The distinct windows that share ``k`` with different ones are
dealt to shards of about ``SHARD_BYTES`` by ``k``; the windows of a ``k``
with more than ``SHARD_WINDOWS`` are spread over several shards.  A shard is
one suffix array: Larsson-Sadakane refinement (groups of equal prefixes are
split by the group of the suffix ``h`` bytes on, ``h`` doubling, sorted
suffixes are left alone) until the longest window is compared, then Kasai's
common prefixes, one lane for each window (what a lane keeps from suffix to
suffix holds only if the order is that of whole suffixes, equal ones by
place).  Neighbours with ``LENGTH`` bytes in common are one class; it repeats
if its windows count two or more.

*Merging.*  Of a ``k`` spread over shards, every shard gives its classes as
sorted runs of fingerprints, cut into buckets; the runs of a bucket are
brought together and each entry is looked up by binary search in them.

Defined cases: null text is an empty text; matches never cross documents;
texts shorter than ``LENGTH`` bytes lose nothing by themselves; repeated rows
are other places, so each loses all repeated bytes; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import discard, materialize, text_or_empty

LENGTH = 400
REACH = 256
SHARD_BYTES = 2 << 20
SHARD_WINDOWS = 4096
CHUNK = 1 << 22
PAD = 7
_LOW = (1 << 24) - 1


def reach_of(length: int) -> int:
    """How far the anchor may lie behind a start."""
    if length < 16:
        raise ValueError("length must be at least 16 bytes")
    return min(REACH, length * 5 // 8)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, first byte lowest."""
    x = text.astype(np.uint64)
    for shift, width in ((1, 8), (2, 16), (4, 32)):
        x = x[:-shift] | (x[shift:] << np.uint64(width))
    return x


def _home_windows(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, first start, last start)`` of the home windows of a text
    of at most ``CHUNK + length`` bytes."""
    reach, starts = reach_of(length), len(data) - length + 1
    x = _words(np.frombuffer(data, dtype=np.uint8))
    h = x * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # Place in the low bits, counted down: of equal hashes the last one wins.
    least = (h & ~np.uint64(_LOW)) | (np.uint64(_LOW) - np.arange(len(h), dtype=np.uint64))
    s = 1
    while 2 * s <= reach:
        least = np.minimum(least[:-s], least[s:])
        s *= 2
    if s < reach:
        least = np.minimum(least[:s - reach], least[reach - s:])
    anchor = _LOW - (least[:starts] & np.uint64(_LOW)).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    first = np.concatenate([[0], cut])
    return anchor[first], first, np.concatenate([cut, [starts]]) - 1


def home_windows(data: bytes, length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """``(k, d, lo, size)``: hashes, first start and number of starts."""
    found, tail = [], length - reach_of(length) + 1
    digest = xxhash.xxh3_64_intdigest
    for base in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[base:base + CHUNK + length - 1]
        anchor, lo, hi = _home_windows(part, length)
        found += [(digest(part[a:a + tail]), digest(part[s:e + length]), base + s, e - s + 1)
                  for a, s, e in zip(anchor.tolist(), lo.tolist(), hi.tolist(), strict=True)]
    return found


def scan(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``[id, key, n_bytes, sha256, windows]``: the only pass over all texts."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, shas, offsets, found = [], [], [0], []
            for text in batch.column(2):
                data = text.as_py().encode()
                sizes.append(len(data))
                shas.append(hashlib.sha256(data).hexdigest())
                found += home_windows(data, length)
                offsets.append(len(found))
            cols = np.array(found, dtype=np.uint64).reshape(-1, 4)
            windows = pa.StructArray.from_arrays(
                [pa.array(cols[:, 0].view(np.int64)), pa.array(cols[:, 1].view(np.int64)),
                 pa.array(cols[:, 2].astype(np.int64)), pa.array(cols[:, 3].astype(np.int32))],
                names=["k", "d", "lo", "size"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), windows)],
                names=["id", "key", "n_bytes", "sha256", "windows"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("key"),
                       text_or_empty(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(read, f"id {id_type}, key long, n_bytes long, sha256 string, "
                                 "windows array<struct<k:long,d:long,lo:long,size:int>>")


def suffix_array(text: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sa, rank)`` by Larsson-Sadakane refinement to ``depth`` bytes.

    ``text`` holds strings of bytes, each followed by ``PAD`` cells; ``end``
    is the end of the string around each cell (0 at padding).  ``rank`` is
    the group number (1 + place of its first suffix), 0 past a string's end."""
    symbols = np.where(end > 0, text.astype(np.uint64) + np.uint64(1), np.uint64(0))
    key = np.zeros(len(text), dtype=np.uint64)
    for k in range(PAD):
        key[:len(key) - k] |= symbols[k:] << np.uint64(9 * (PAD - 1 - k))
    inside = np.flatnonzero(end > 0)
    order = np.argsort(key[inside], kind="stable")
    sa, sorted_key = inside[order], key[inside][order]
    rank = np.zeros(len(text), dtype=np.int64)
    slots = np.arange(len(sa))

    def regroup(slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Number the groups of equal values at ``slots``; the slots of
        groups with more than one suffix."""
        new = np.ones(len(slots), dtype=bool)
        new[1:] = values[1:] != values[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(slots)))
        rank[sa[slots]] = np.repeat(slots[first], size) + 1
        return slots[np.repeat(size > 1, size)]

    open_slots = regroup(slots, sorted_key)
    h = PAD
    while h < depth and len(open_slots):
        suffix = sa[open_slots]
        after = np.minimum(suffix + h, len(text) - 1)
        follow = np.where(suffix + h < end[suffix], rank[after], 0)
        value = (rank[suffix] << 32) | follow
        order = np.argsort(value, kind="stable")
        sa[open_slots] = suffix[order]
        open_slots = regroup(open_slots, value[order])
        h *= 2
    return sa, rank


def common_prefixes(text: np.ndarray, end: np.ndarray, first: np.ndarray, sa: np.ndarray, most: int,
                    least: int = 1) -> np.ndarray:
    """Kasai: bytes (at most ``most``) that each suffix of ``sa`` shares
    with the one before it.  Strings (starting at ``first``) are lanes that
    step through their suffixes together; a lane keeps its prefix, less one,
    from suffix to suffix, so ``sa`` has to order whole suffixes.  Suffixes
    under ``least`` bytes are left at 0."""
    words = _words(text)
    before = np.full(len(text), -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    size = end[first] - first
    lanes = np.argsort(-size, kind="stable")
    start, size = first[lanes], size[lanes]
    held = np.zeros(len(lanes), dtype=np.int64)
    shared = np.zeros(len(text), dtype=np.int64)
    for step in range(max(0, int(size[0]) - least + 1) if len(size) else 0):
        n = int(np.searchsorted(-size, -step - least, side="right"))  # lanes with ``least`` bytes from here
        i = start[:n] + step
        j = before[i]
        held[:n] = np.maximum(held[:n] - 1, 0)
        held[:n][j < 0] = 0
        room = np.minimum(np.minimum(end[i] - i, np.where(j >= 0, end[j] - j, 0)), most)
        going = np.flatnonzero(held[:n] < room)
        while len(going):
            at = held[going]
            differ = words[i[going] + at] ^ words[j[going] + at]
            # Equal low bytes: those below the lowest bit that differs (all eight of none).
            held[going] += np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3
            going = going[(differ == 0) & (held[going] < room[going])]
        held[:n] = np.minimum(held[:n], room)
        shared[i] = held[:n]
    return shared[sa]


def shard_repeats(windows: list[bytes], counts: np.ndarray, spread: np.ndarray, length: int):
    """Repeats among the windows of a shard.

    Returns ``(window, start)`` of every start whose class counts two or
    more, and ``(window, start, repeated)`` of one start of every class of
    the ``spread`` windows."""
    size = np.array([len(w) for w in windows], dtype=np.int64)
    first = np.cumsum(size + PAD) - size - PAD
    text = np.frombuffer(b"".join(w + b"\0" * PAD for w in windows), dtype=np.uint8)
    end, owner = np.zeros(len(text), dtype=np.int64), np.zeros(len(text), dtype=np.int64)
    for k, (a, n) in enumerate(zip(first.tolist(), size.tolist(), strict=True)):
        end[a:a + n] = a + n
        owner[a:a + n] = k
    sa, _ = suffix_array(text, end, int(size.max(initial=0)))
    joined = common_prefixes(text, end, first, sa, length, length) >= length
    starts = end[sa] - sa >= length
    group = np.cumsum(~joined)
    weight = np.bincount(group, weights=counts[owner[sa]])
    twice = starts & (weight[group] > 1)
    found = sa[twice]
    runs = np.flatnonzero(starts & ~joined & np.isin(group, group[starts & spread[owner[sa]]]))
    return ((owner[found], found - first[owner[found]]),
            (owner[sa[runs]], sa[runs] - first[owner[sa[runs]]], weight[group[runs]] > 1))


SHARD_OUT = ("shard long, k long, d long, a int, b int, bucket int, "
             "run struct<fp:binary,k:array<long>,d:array<long>,a:array<int>,repeated:array<boolean>>")


def _sort_shard(length: int, buckets: int):
    """One row for each range of repeated starts of a window, and for each
    fingerprint bucket the shard's sorted run of classes in it."""
    def sort(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["k", "d"]).sort_values(["k", "d"])
        shard, k, d = int(group["shard"].iloc[0]), group["k"].to_numpy(), group["d"].to_numpy()
        windows = [bytes(b) for b in group["bytes"]]
        (window, start), (run_window, run_start, repeated) = shard_repeats(
            windows, group["n"].to_numpy(), group["spread"].to_numpy(), length)
        rows = []
        order = np.lexsort((start, window))
        window, start = window[order], start[order]
        if len(start):
            cut = np.flatnonzero((np.diff(window) != 0) | (np.diff(start) != 1)) + 1
            for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(start)).tolist(), strict=True):
                w = window[a]
                rows.append((shard, k[w], d[w], int(start[a]), int(start[b - 1]) + 1, None, None))
        if len(run_window):
            digest = xxhash.xxh3_128_digest
            fps = np.array([digest(windows[w][x:x + length]) for w, x in zip(
                run_window.tolist(), run_start.tolist(), strict=True)], dtype="V16")
            bucket = fps.view("<u8")[::2] % np.uint64(buckets)
            order = np.lexsort((fps.view(">u8")[1::2], fps.view(">u8")[::2], bucket))
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            for own in np.split(order, cut):
                w = run_window[own]
                rows.append((shard, None, None, None, None, int(bucket[own[0]]), {
                    "fp": fps[own].tobytes(), "k": k[w].tolist(), "d": d[w].tolist(),
                    "a": run_start[own].tolist(), "repeated": repeated[own].tolist()}))
        # As objects: 64-bit integers beside nulls would become floats.
        return pd.DataFrame(rows, columns=["shard", "k", "d", "a", "b", "bucket", "run"], dtype=object)

    return sort


def _merge_runs(group: pd.DataFrame) -> pd.DataFrame:
    """Entries of a bucket's sorted runs that another shard has too: each run
    is looked up by binary search in all of them together."""
    runs = [np.frombuffer(r["fp"], dtype=">u8").reshape(-1, 2) for r in group["run"]]
    merged = np.concatenate(runs)
    merged = merged[np.lexsort((merged[:, 1], merged[:, 0]))]
    high = merged[:, 0].astype(np.uint64)
    rows = []
    for entries, run in zip(runs, group["run"], strict=True):
        own = entries[:, 0].astype(np.uint64)
        first, after = np.searchsorted(high, own, "left"), np.searchsorted(high, own, "right")
        for e in np.flatnonzero((after - first > 1) & ~np.array(run["repeated"], dtype=bool)).tolist():
            # A shard has a class once: two equal entries are two shards.
            if (merged[first[e]:after[e], 1] == entries[e, 1]).sum() > 1:
                a = int(run["a"][e])
                rows.append((int(run["k"][e]), int(run["d"][e]), a, a + 1))
    return pd.DataFrame(rows, columns=["k", "d", "a", "b"])


def repeated_starts(windows: DataFrame, length: int) -> DataFrame:
    """``[k, d, a, b]``: starts ``a..b-1`` of window ``(k, d)`` whose string
    is found in another window of ``windows [k, d, n, n_windows, bytes]``."""
    total = windows.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    parts = F.ceil(F.col("n_windows") / SHARD_WINDOWS)
    dealt = windows.select(
        F.pmod(F.xxhash64("k", F.pmod(F.xxhash64("d"), parts)), F.lit(shards)).alias("shard"), "k", "d", "n",
        (parts > 1).alias("spread"), "bytes")
    sorted_out = materialize(dealt.groupBy("shard").applyInPandas(_sort_shard(length, shards), SHARD_OUT), "shards")
    merged = (sorted_out.where("run IS NOT NULL").groupBy("bucket")
              .applyInPandas(_merge_runs, "k long, d long, a int, b int"))
    starts = materialize(sorted_out.where("run IS NULL").select("k", "d", "a", "b").unionByName(merged), "starts")
    discard(sorted_out)
    return starts


def _without(length: int):
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for text, ranges in zip(texts, found, strict=True):
            data = text.encode()
            bounds = np.array([(r["a"], r["b"]) for r in ranges], dtype=np.int64)
            edge = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(edge, bounds[:, 0], 1)
            np.add.at(edge, bounds[:, 1] + length - 1, -1)
            gone = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
            starts, ends = (np.flatnonzero(gone[1:] & ~gone[:-1]).tolist(), np.flatnonzero(~gone[1:] & gone[:-1]).tolist())
            kept = b"".join(data[a:b] for a, b in zip([0, *ends], [*starts, len(data)], strict=True))
            rows.append(([{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)], kept))
        return pd.DataFrame(rows, columns=["spans", "kept"])

    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """``[id_col, n_bytes, spans, kept, kept_sha256]``: for every row the
    maximal removed byte runs ``[start, end)`` and the remaining bytes
    (``kept`` is null where nothing was removed: the text is as it was)."""
    scanned = materialize(scan(docs, id_col, text_col, length), "scan")
    occurrences = scanned.select("id", "key", F.explode("windows").alias("w")).select("id", "key", "w.*")
    twice = occurrences.groupBy("k").agg(F.count(F.lit(1)).alias("n_k")).where("n_k > 1").drop("n_k")
    twice = materialize(twice, "keys")
    occurrences = materialize(occurrences.join(twice, "k").withColumn("place", F.xxhash64("id", "key", "lo")), "occurrences")
    # One row per distinct window, with its count and one of its places.
    distinct = materialize(occurrences.groupBy("k", "d").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("at")),
                           "distinct")
    by_key = materialize(distinct.groupBy("k").agg(F.count(F.lit(1)).alias("n_windows")), "by_key")
    counted = materialize(distinct.join(by_key, "k"), "counted")
    marked = occurrences.join(counted, ["k", "d"]).withColumn(
        "sorted", (F.col("place") == F.col("at")) & (F.col("n_windows") > 1)).drop("place", "at")
    by_row = materialize(marked.dropDuplicates(["id", "key", "lo"]).groupBy("id", "key").agg(
        F.collect_list(F.struct("k", "d", "lo", "size", "n", "n_windows", "sorted")).alias("windows")), "by_row")
    discard(twice, occurrences, distinct, by_key, counted)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("key"),
                        text_or_empty(text_col).alias("text"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    renamed = by_row.withColumnsRenamed({"id": "_id", "key": "_key"})
    # Equal rows have equal windows, whose counts hold the repeats: one of them is enough.
    candidates = materialize(texts.join(renamed, same).select("id", "key", "text", "windows").dropDuplicates(
        ["id", "key"]), "candidates")
    to_sort = candidates.select(F.encode("text", "UTF-8").alias("b"), F.explode(F.filter(
        "windows", lambda w: w["sorted"])).alias("w")).select(
        "w.k", "w.d", "w.n", "w.n_windows",
        F.substring("b", F.col("w.lo").cast("int") + 1, F.col("w.size") + (length - 1)).alias("bytes"))
    to_sort = materialize(to_sort, "windows")
    starts = repeated_starts(to_sort, length)
    # Starts of each row: whole windows that occur twice, and those found in other windows.
    placed = candidates.select("id", "key", F.explode("windows").alias("w")).select(
        "id", "key", "w.k", "w.d", "w.lo", "w.size", "w.n")
    whole = placed.where("n > 1").select("id", "key", F.col("lo").alias("a"), (F.col("lo") + F.col("size")).alias("b"))
    partly = placed.where("n = 1").join(starts, ["k", "d"]).select(
        "id", "key", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b"))
    found = whole.unionByName(partly).groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(
        F.collect_list(F.struct("a", "b")).alias("found"))
    cut = F.pandas_udf(_without(length), "spans array<struct<start:long,end:long>>, kept binary")
    changed = candidates.join(found, same).select("_id", "_key", cut("text", "found").alias("c")).select(
        "_id", "_key", "c.*")
    changed = materialize(changed, "changed")
    discard(by_row, candidates, to_sort, starts)
    return scanned.drop("windows").join(changed, same, "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"), "kept",
        F.when(F.col("kept").isNull(), F.col("sha256")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))
