"""Best-fit packing by exact complements.

Documents become token pieces of at most ``capacity`` ids; pieces are packed
into as few sequences as possible.  Only the histogram of piece lengths
(at most ``capacity`` rows, whatever the corpus size) decides the packing:

1. ``packing_plan`` takes the longest remaining length and looks up its gap
   in a hash index of the sums of single lengths, pairs and triples
   (``SumIndex``, updated as counts run out); what it finds fills the gap
   exactly and is consumed in bulk.  What is left is best-fit.  The result is
   a list of patterns ``(lengths, count)``.
2. Every piece gets a rank within its length class and looks up the pattern
   slot that owns this rank: its sequence and its offset there.

The rank is ``pieces of that length in earlier write tasks + rank in the own
task``, both recorded when the pieces are written, so no length class (a
third of all documents may be empty) meets in one task.

Defined cases: null text is an empty text (one id, the separator); repeated
rows are packed separately; an empty table gives no pieces; other columns of
the input are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusml.llm.common import materialize, text_or_empty

CAPACITY = 2048
SEPARATOR_ID = 0
VOCABULARY = "byte_bpe_50k.tiktoken"
PIECES = "piece int, start long, length long, ids_crc32 long, part int, local_rank long"
#: Runs of this much white space (``\s`` of the pattern) are encoded apart.
LONG_SPACE = 1 << 16
_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """The byte-level BPE at ``path`` (token and rank per line).  The ids are
    those of the ``tokenizers`` file of the same vocabulary; the tests
    compare both over whole tables."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def encode_text(bpe, text: str) -> list[int]:
    """The ids of ``text``.  The pattern's look-ahead overflows the regex
    engine's stack on a million characters of white space, so long runs do
    not go through it: a run is one pre-token to the end of the text, else up
    to its last character, which opens the next pre-token."""
    if len(text) < LONG_SPACE:
        return bpe.encode_ordinary(text)
    ids, at = [], 0
    for run in _SPACES.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += bpe.encode_ordinary(text[at:run.start()]) + bpe._encode_single_piece(text[run.start():end])
        at = end
    return ids + bpe.encode_ordinary(text[at:])


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_bounds(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document: whole if it fits,
    else a shorter first piece followed by full ones."""
    first = n_ids % capacity or capacity
    if n_ids <= capacity:
        return [(0, n_ids)]
    return [(0, first)] + [(s, capacity) for s in range(first, n_ids, capacity)]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, vocabulary: str | None = None,
                 keep_ids: bool = False) -> DataFrame:
    """``[id_col, piece, start, length, ids_crc32, part, local_rank(, ids)]``;
    ``local_rank`` counts the pieces of one length within a task."""
    path = vocabulary or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = byte_bpe(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            keys = batch.column(0)
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1)):
                ids = np.array(encode_text(bpe, text.as_py()) + [SEPARATOR_ID], dtype="<u4")
                for piece, (start, n) in enumerate(piece_bounds(len(ids), capacity)):
                    own = ids[start:start + n]
                    rows.append((i, piece, start, n, zlib.crc32(own.tobytes()), seen[n],
                                 own.astype(np.int64) if keep_ids else None))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            arrays = [keys.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                      pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                      pa.array(cols[4], pa.int64()), pa.array([part] * len(rows), pa.int32()),
                      pa.array(cols[5], pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32", "part", "local_rank"]
            if keep_ids:
                arrays.append(pa.array(cols[6], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    source = docs.select(F.col(id_col), text_or_empty(text_col).alias(text_col))
    id_type = source.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {PIECES}" + ", ids array<bigint>" * keep_ids
    return source.mapInArrow(encode, schema)


class SumIndex:
    """The available lengths by the sums of one, two and three of them.

    ``free`` (counts by length) has the single sums, ``pairs`` the larger
    members of every pair sum and ``triples`` the largest members of every
    triple sum (the other two are the pair sum of the remainder), longest
    first.  Its size depends on the capacity alone.  Lengths are asked for
    from the longest down and counts only fall, so an entry that can fill
    nothing any more leaves its list when it is met."""

    def __init__(self, free: np.ndarray):
        self.free = free
        there, size = free > 0, len(free)
        lengths, summed = np.flatnonzero(there)[::-1], np.zeros(size, dtype=bool)
        self.pairs: dict[int, np.ndarray] = {}
        self.triples: dict[int, np.ndarray] = {}
        for total in range(2, size):
            larger = lengths[(lengths < total) & (lengths * 2 >= total)]
            larger = larger[there[total - larger]]
            if len(larger):
                self.pairs[total], summed[total] = larger, True
        for total in range(3, size):
            largest = lengths[(lengths < total - 1) & (lengths * 3 >= total)]
            largest = largest[summed[total - largest]]
            if len(largest):
                self.triples[total] = largest

    def _enough(self, lengths: tuple[int, ...]) -> bool:
        return all(self.free[x] >= lengths.count(x) for x in lengths)

    def _pair(self, total: int, held: tuple[int, ...]) -> tuple[int, int] | None:
        """Two lengths up to the last of ``held`` that sum to ``total`` and
        are available beside ``held``."""
        if total not in self.pairs:
            return None
        larger = self.pairs[total]
        larger = self.pairs[total] = larger[(self.free[larger] > 0) & (self.free[total - larger] > 0)]
        for x in larger[np.searchsorted(-larger, -held[-1]):].tolist():
            if self._enough((*held, x, total - x)):
                return x, total - x
        return None

    def complement(self, length: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths, none above ``length``, that sum to
        exactly ``gap`` and are available beside one ``length``."""
        if gap <= length and self._enough((length, gap)):
            return (gap,)
        if found := self._pair(gap, (length,)):
            return found
        largest = self.triples.pop(gap, None)
        if largest is None:
            return None
        largest = largest[(self.free[largest] > 0) & (largest <= length)]
        for at, x in enumerate(largest.tolist()):
            if self._enough((length, x)) and (rest := self._pair(gap - x, (length, x))):
                self.triples[gap] = largest[at:]
                return (x, *rest)
        return None


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, how often)`` that use up the histogram.

    Each bulk step exhausts a length or a group of open sequences, so the
    plan has a few times ``capacity`` patterns at most."""
    free = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        free[length] = count
    plan: list[tuple[tuple[int, ...], int]] = []
    if free[capacity]:
        plan.append(((capacity,), int(free[capacity])))
        free[capacity] = 0
    index = SumIndex(free)
    for length in range(capacity - 1, 0, -1):
        while free[length] and (others := index.complement(length, capacity - length)):
            lengths = (length, *others)
            times = min(int(free[x]) // lengths.count(x) for x in lengths)
            for x in lengths:
                free[x] -= times
            plan.append((lengths, times))
    open_by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        left = int(free[length])
        for gap in sorted(g for g in open_by_gap if g >= length):
            while left and open_by_gap[gap]:
                lengths, count = open_by_gap[gap].pop()
                each = min(gap // length, left)
                used = min(count, left // each)
                if used < count:
                    open_by_gap[gap].append((lengths, count - used))
                open_by_gap.setdefault(gap - each * length, []).append((lengths + (length,) * each, used))
                left -= used * each
        each = capacity // length
        for copies, times in ((each, left // each), (left % each, 1)):
            if copies and times:
                open_by_gap.setdefault(capacity - copies * length, []).append(((length,) * copies, times))
    return plan + [p for patterns in open_by_gap.values() for p in patterns]


def slot_table(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan's slots as arrays sorted by (length, first rank): ranks
    ``first..first+times-1`` of ``length`` go to sequences ``base..`` at
    ``offset``."""
    taken: dict[int, int] = {}
    slots, base = [], 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            first = taken.get(x, 0)
            slots.append((x, first, base, offset))
            taken[x] = first + times
            offset += x
        base += times
    slots.sort()
    a = np.array(slots, dtype=np.int64).reshape(-1, 4)
    return {"length": a[:, 0], "first": a[:, 1], "base": a[:, 2], "offset": a[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written once, with ``part`` and ``local_rank``) plus
    ``sequence_id`` and ``offset``."""
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    slots = slot_table(packing_plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        x, r = length.to_numpy(), rank.to_numpy()
        starts = np.searchsorted(slots["length"], x)
        out = np.empty((len(x), 2), dtype=np.int64)
        for value in np.unique(x):
            own = x == value
            lo = int(starts[np.argmax(own)])
            hi = int(np.searchsorted(slots["length"], value, side="right"))
            k = lo + np.searchsorted(slots["first"][lo:hi], r[own], side="right") - 1
            out[own, 0] = slots["base"][k] + r[own] - slots["first"][k]
            out[own, 1] = slots["offset"][k]
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    ranked = pieces.join(shifts, ["part", "length"])
    placed = ranked.withColumn("_slot", place("length", F.col("shift") + F.col("local_rank")))
    return placed.select("*", "_slot.sequence_id", "_slot.offset").drop("_slot", "shift", "part", "local_rank")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, vocabulary: str | None = None,
                   keep_ids: bool = False) -> DataFrame:
    """``[id_col, piece, start, length, ids_crc32(, ids), sequence_id,
    offset]``: every token of every document in a sequence of at most
    ``capacity`` ids."""
    pieces = materialize(token_pieces(docs, id_col, text_col, capacity, vocabulary, keep_ids), "pieces")
    return pack(pieces, capacity)
