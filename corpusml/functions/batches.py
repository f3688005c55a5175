"""Tokens for whole Arrow batches.

The same dump (``views.hex_dump``), tokens (``tokens.byte_tokens``, the
candidates of ``tokens.asm_tokens`` and ``tokens.joint_tokens``) and n-grams
(``tokens.ngrams``) as the column functions, made by numpy from the bytes of
a batch: no object per token.  For jobs that read every text more than once
or keep few of its words; it is a map next to the scan (or above a join), so
filters and column choices belong below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Set

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from corpusml.functions.views import BASE_ADDRESS, BYTES_PER_LINE
from corpusml.session import package_on_workers

DIGITS = np.frombuffer(b"0123456789ABCDEF", dtype=np.uint8)
PAIRS = np.array([list(b" %02X" % b) for b in range(256)], dtype=np.uint8)
IS_HEX = np.isin(np.arange(256), DIGITS)
ADDRESS_DIGITS = 8
IS_WORD = np.array([chr(b).isascii() and (chr(b).isalnum() or chr(b) == "_") for b in range(256)])
IS_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\f\r", dtype=np.uint8))
#: Tokens of an outgoing batch (one more document may follow).
BATCH_TOKENS = 1 << 20
#: Bytes of the texts that are cut together (one more document may follow).
SLICE_BYTES = 4 << 20


def dump_bytes(text: bytes) -> np.ndarray:
    """The characters of ``hex_dump`` of one text."""
    size = len(text)
    lines = -(-size // BYTES_PER_LINE)
    padded = np.zeros(lines * BYTES_PER_LINE, dtype=np.uint8)
    padded[:size] = np.frombuffer(text, dtype=np.uint8)
    dump = np.empty((lines, ADDRESS_DIGITS + 3 * BYTES_PER_LINE + 1), dtype=np.uint8)
    address = BASE_ADDRESS + BYTES_PER_LINE * np.arange(lines, dtype=np.int64)
    shifts = 4 * np.arange(ADDRESS_DIGITS - 1, -1, -1)
    dump[:, :ADDRESS_DIGITS] = DIGITS[(address[:, None] >> shifts) & 15]
    dump[:, ADDRESS_DIGITS:-1] = PAIRS[padded].reshape(lines, 3 * BYTES_PER_LINE)
    dump[:, -1] = ord("\n")
    return dump.ravel()[:max(0, dump.size - 3 * (padded.size - size) - 1)]


def token_bytes(dump: np.ndarray) -> np.ndarray:
    """``byte_tokens`` of the characters of a text: rows of two digits."""
    digit = IS_HEX[dump]
    at = np.flatnonzero((dump[:-2] == ord(" ")) & digit[1:-1] & digit[2:]) if dump.size > 2 else np.empty(0, np.int64)
    return np.stack([dump[at + 1], dump[at + 2]], axis=1)


def gram_bytes(tokens: np.ndarray, n: int) -> np.ndarray:
    """``ngrams`` of tokens of two characters: rows of ``3 n - 1``."""
    rows = max(0, len(tokens) - n + 1)
    grams = np.full((rows, 3 * n - 1), ord(" "), dtype=np.uint8)
    for k in range(n):
        grams[:, 3 * k:3 * k + 2] = tokens[k:k + rows]
    return grams


def _lists(grams: list[np.ndarray | None], width: int) -> pa.Array:
    ends = np.cumsum([0] + [0 if g is None else len(g) for g in grams], dtype=np.int32)
    data = np.concatenate([g.ravel() for g in grams if g is not None] or [np.empty(0, np.uint8)])
    offsets = np.arange(ends[-1] + 1, dtype=np.int32) * np.int32(width)
    strings = pa.StringArray.from_buffers(int(ends[-1]), pa.py_buffer(offsets), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(ends), strings, mask=pa.array([g is None for g in grams]))


def dumped_byte_tokens(docs: DataFrame, n: int = 1, text: str = "text", features: str = "features") -> DataFrame:
    """``docs`` with its column ``text`` replaced by ``features``: the
    ``n``-grams of the byte tokens of the text's hex dump (null for null)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    package_on_workers(docs.sparkSession)
    keep = [c for c in docs.columns if c != text]
    schema = docs.select(*keep).schema.add(features, ArrayType(StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            own, begin, tokens = [], 0, 0
            for row in range(batch.num_rows):
                value = texts[row].as_py()
                own.append(None if value is None else gram_bytes(token_bytes(dump_bytes(value)), n))
                tokens += 0 if value is None else len(own[-1])
                if tokens >= BATCH_TOKENS or row + 1 == batch.num_rows:
                    kept = [batch.column(k).slice(begin, len(own)) for k in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*kept, _lists(own, 3 * n - 1)], names=[*keep, features])
                    own, begin, tokens = [], row + 1, 0

    return docs.select(*keep, text).mapInArrow(run, schema)


def dumped_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its column ``text`` replaced by its hex dump (null for null)."""
    package_on_workers(docs.sparkSession)
    keep = [c for c in docs.columns if c != text]
    rows = docs.select(*keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _slices(batch.column(len(keep))):
                dumps = pa.array([None if t is None else dump_bytes(t).tobytes() for t in texts], pa.binary())
                kept = [batch.column(k).slice(begin, len(texts)) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, dumps.cast(pa.string())], names=[*keep, text])

    return rows.mapInArrow(run, rows.schema)


def _slices(*columns: pa.Array) -> Iterator[tuple]:
    """``(first row, texts of each column)`` for some ``SLICE_BYTES`` at a time."""
    binary = [c.cast(pa.binary()) for c in columns]
    size = sum(np.nan_to_num(pa.compute.binary_length(c).to_numpy(zero_copy_only=False)) for c in binary)
    part = np.cumsum(size) // SLICE_BYTES
    for own in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
        if len(own):
            yield int(own[0]), *(c.slice(own[0], len(own)).to_pylist() for c in binary)


def spans(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The strings ``data[first:end]``, which are in order and do not overlap."""
    offsets = np.zeros(len(first) + 1, dtype=np.int32)
    np.cumsum(end - first, out=offsets[1:])
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[first] += 1
    edge[end] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[inside]))


def _known(words: pa.StringArray, vocabulary: Set[str]) -> np.ndarray:
    coded = words.dictionary_encode()
    known = np.array([w in vocabulary for w in coded.dictionary.to_pylist()], dtype=bool)
    return known[coded.indices.to_numpy()] if len(words) else np.empty(0, dtype=bool)


def listed_tokens(texts: list[list[bytes | None]], vocabulary: Set[str], longest: int, pairs: bool):
    """``(lists, positions)`` of some documents, each given as the list of its
    texts: the ``asm`` tokens (``pairs``: the ``joint`` tokens) of these, one
    text after the other, and the number of every token among the candidates
    (words, titles and pairs) of its document.  A null text: a null list.

    A candidate is a whole word run; a run before ``:``, eight hex digits and
    white space is a title, with a dot before it; two runs of two hex digits
    with one blank between are a pair, taken from the left.  ``longest``: the
    bytes of the longest word."""
    whole = [None not in t for t in texts]
    # A zero byte ends every text: no token holds one.
    parts = [b"\0".join(t) + b"\0" if ok else b"" for t, ok in zip(texts, whole, strict=True)]
    begin = 1 + np.cumsum([0] + [len(p) for p in parts], dtype=np.int64)
    data = np.frombuffer(b"\0" + b"".join(parts) + bytes(ADDRESS_DIGITS + 2), dtype=np.uint8)
    word = IS_WORD[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    first, end = edge[::2].copy(), edge[1::2].copy()
    title = data[end] == ord(":")
    at = np.flatnonzero(title)
    title[at] = IS_SPACE[data[end[at] + ADDRESS_DIGITS + 1]]
    for k in range(1, ADDRESS_DIGITS + 1):
        title[at] &= IS_HEX[data[end[at] + k]]
    head = tail = np.zeros(len(first), dtype=bool)
    if pairs and len(first):
        two = (end - first == 2) & IS_HEX[data[first]] & IS_HEX[data[first + 1]]
        linked = np.append(two[:-1] & two[1:] & (first[1:] == end[:-1] + 1) & (data[end[:-1]] == ord(" ")), False)
        follows = np.append(False, linked[:-1])
        place = np.arange(len(first))
        odd = (place - np.maximum.accumulate(np.where(follows, 0, place))) % 2 == 1
        head, tail = linked & ~odd, follows & odd
    title &= ~tail
    plain = np.flatnonzero(~(head | title | tail) & (end - first <= longest))
    keep = head | title
    keep[plain] = _known(spans(data, first[plain], end[plain]), vocabulary)
    first -= title & (data[first - 1] == ord("."))
    end[head] = end[1:][head[:-1]]
    end[title] += 1
    number = np.cumsum(~tail) - 1
    kept = np.flatnonzero(keep)
    ends = np.searchsorted(first[kept], begin)
    before = np.append(0, np.cumsum(~tail))[np.searchsorted(first, begin[:-1])]
    positions = number[kept] - np.repeat(before, np.diff(ends))
    mask, offsets = pa.array([not ok for ok in whole]), pa.array(ends.astype(np.int32))
    return (pa.ListArray.from_arrays(offsets, spans(data, first[kept], end[kept]), mask=mask),
            pa.ListArray.from_arrays(offsets, pa.array(positions.astype(np.int32)), mask=mask))


def with_listed_tokens(docs: DataFrame, texts: list[str], vocabulary: Callable[[], Set[str]], pairs: bool,
                       features: str = "features", positions: str | None = None) -> DataFrame:
    """``docs`` with its columns ``texts`` replaced by ``features``, their
    ``listed_tokens`` (and ``positions``); ``vocabulary`` gives the words in a task."""
    package_on_workers(docs.sparkSession)
    keep = [c for c in docs.columns if c not in texts]
    schema = docs.select(*keep).schema.add(features, ArrayType(StringType()))
    if positions:
        schema = schema.add(positions, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary()
        longest = max((len(w.encode()) for w in words), default=0)
        for batch in batches:
            for begin, *own in _slices(*batch.columns[len(keep):]):
                found = listed_tokens([list(t) for t in zip(*own, strict=True)], words, longest, pairs)
                kept = [batch.column(k).slice(begin, len(own[0])) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *found[:1 + bool(positions)]], names=schema.names)

    return docs.select(*keep, *texts).mapInArrow(run, schema)


def document_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``[word, n]``: for every slice of rows its words (whole runs) and the
    number of rows that hold them; summed, the document counts."""
    package_on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                parts = [b"" if t is None else t + b"\0" for t in texts]
                begin = 1 + np.cumsum([0] + [len(p) for p in parts], dtype=np.int64)
                data = np.frombuffer(b"\0" + b"".join(parts) + b"\0", dtype=np.uint8)
                word = IS_WORD[data]
                edge = np.flatnonzero(word[1:] != word[:-1]) + 1
                coded = spans(data, edge[::2], edge[1::2]).dictionary_encode()
                rows = np.searchsorted(begin, edge[::2], side="right") - 1
                codes = coded.indices.to_numpy().astype(np.int64)
                size = max(1, len(coded.dictionary))
                once = pa.array(rows * size + codes).unique().to_numpy() % size
                counts = np.bincount(once, minlength=len(coded.dictionary)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(counts)], names=["word", "n"])

    return docs.select(text).mapInArrow(run, StructType().add("word", StringType()).add("n", LongType()))
