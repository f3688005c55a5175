"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint has 8 bytes.  Two fingerprints at ``max_bits`` or fewer
differing bits share at least ``8 - max_bits`` bytes *at the same position*:
the guaranteed minimum.  The inverted index is keyed by positions and the
bytes found there, one position fewer than guaranteed; as a pair's first k
shared positions lie among the first ``max_bits + k``, only choices of those
are posted (35 for 3 positions at 4 bits).  Pairs that meet in a posting list
have their shared positional bytes tallied over all 8 positions; pairs under
the minimum are discarded and the rest is verified on its bits.

Exact copies are one fingerprint, posted once.  Lists with a single entry
are dropped by a count before anything is gathered.  A list longer than
``BLOCK`` is not gathered but posted anew under a further position behind its
last one, which again covers every pair, until the positions are as many as
guaranteed; a list still longer is posted under half bytes of its other
positions (``max_bits`` of those ``2 * max_bits`` are equal in every link).
What then meets differs in the other half bytes alone: at 4 bits at most
65,536 different fingerprints, however large the corpus is.  A group returns
links that span its components, not all pairs: the same classes follow.

Defined cases: null text is an empty text; texts without words have
fingerprint zero and are linked like any other; repeated rows and repeated
ids are separate rows; a null id is never a component id unless the
component has no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusml.llm.common import discard, materialize, text_or_empty
from corpusml.llm.components import component_roots

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Longest posting list that is gathered while a further position can split it.
BLOCK = 1024
#: Postings that one task makes.
TASK_POSTINGS = 500_000
#: Bit i of a byte as byte lane i of a 64-bit word, to add up bits of 255 hashes at a time.
LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles (repeats count) as unsigned int."""
    words = text.encode().lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    last = ends[shingle_words - 1:] if len(words) >= shingle_words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)],
                      dtype=np.uint64).view(np.uint8).reshape(n, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 255):
        ones += LANES[hashes[i:i + 255]].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``[id_col, text_key, fp]``: one row per row of ``docs``; ``text_key``
    is a hash of the text, ``fp`` the fingerprint as signed long."""
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return rows.select(id_col, F.xxhash64("_text").alias("text_key"), simhash("_text").alias("fp"))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def mask_of(positions: Iterable[int], width: int = 8) -> int:
    """The bits at ``positions`` of ``width`` bits each."""
    return sum(((1 << width) - 1) << (width * p) for p in positions)


def posting_masks(max_bits: int) -> list:
    """The masks of the first index, then for every finer one the masks that
    follow each mask before it."""
    shared = 8 - max_bits
    least = max(1, shared - 1)
    choices = list(combinations(range(max_bits + least), least))
    levels: list = [[mask_of(c) for c in choices]]
    for k in range(least, shared):
        after = {c: [(*c, p) for p in range(c[-1] + 1, max_bits + k + 1)] for c in choices}
        levels.append({mask_of(c): [mask_of(d) for d in ds] for c, ds in after.items()})
        choices = [d for ds in after.values() for d in ds]
    halves = {}
    for c in choices:
        others = [h for h in range(16) if h // 2 not in c]
        halves[mask_of(c)] = [mask_of(c) | mask_of(half, 4) for half in combinations(others, max_bits)]
    return [*levels, halves]


def tally(fps: np.ndarray, one: np.uint64) -> np.ndarray:
    """How many positional bytes each of ``fps`` shares with ``one``."""
    return ((fps ^ one).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def spanning_links(fps: np.ndarray, max_bits: int, shared: int) -> list[tuple[int, int]]:
    """Links that span the components of one group of fingerprints."""
    links, rest = [], np.arange(len(fps))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = tally(fps[rest], fps[x]) >= shared
            near[near] = np.bitwise_count(fps[rest[near]] ^ fps[x]) <= max_bits
            found = rest[near]
            links += [(int(x), int(y)) for y in found]
            queue += found.tolist()
            rest = rest[~near]
    return links


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``[u, v]``: links (at most ``max_bits`` bits) that span the classes
    of the fingerprints in ``distinct [fp]``."""
    if not 0 < max_bits < 8:
        raise ValueError("max_bits must be 1 to 7: the count filter needs a shared byte")
    spark, shared = distinct.sparkSession, 8 - max_bits
    first, *finer = posting_masks(max_bits)
    # The few bytes of a fingerprint become many postings: spread them first.
    parts = max(1, -(-distinct.count() * len(first) // TASK_POSTINGS))
    postings = distinct.repartition(parts, "fp").select(
        "fp", F.explode(F.array(*[F.lit(signed(m)) for m in first])).alias("mask"))

    @F.pandas_udf("array<struct<u:long,v:long>>")
    def link(lists: pd.Series) -> pd.Series:
        found = []
        for fps in lists:
            own = np.unique(np.asarray(fps, dtype=np.int64)).view(np.uint64)
            ids = own.view(np.int64).tolist()
            found.append([{"u": ids[x], "v": ids[y]} for x, y in spanning_links(own, max_bits, shared)])
        return pd.Series(found)

    found, keys, written = [], ["mask", "bytes"], []
    for further in [*finer, None]:
        postings = postings.withColumn("bytes", F.col("fp").bitwiseAND(F.col("mask")))
        lists = materialize(postings.groupBy(keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "lists")
        # A merge join at every size: ``lists`` grows with the corpus.
        members = postings.join(lists.hint("merge"), keys)
        fits = F.col("n") <= BLOCK if further else F.lit(True)
        groups = members.where(fits).groupBy(keys).agg(F.collect_list("fp").alias("fps"))
        found.append(materialize(groups.select(F.explode(link("fps")).alias("l")).select("l.u", "l.v"), "near"))
        written.append(lists)
        if not further or lists.where(~fits).isEmpty():
            break
        # A fixed table of the method: at most some thousand rows.
        steps = spark.createDataFrame([(signed(m), signed(n)) for m, after in further.items() for n in after],
                                      "mask long, after long")
        postings = materialize(members.where(~fits).select("fp", "mask").join(F.broadcast(steps), "mask").select(
            "fp", F.col("after").alias("mask")), "postings")
        written.append(postings)
    links = materialize(reduce(DataFrame.unionAll, found).distinct(), "links")
    discard(*written, *found)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``[id_col, text_key, fp, root, component_id]`` for every row of
    ``docs``: ``component_id`` is the smallest id reachable over links,
    ``root`` the component's smallest fingerprint (as signed long)."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    near = near_links(classes.select("fp"), max_bits)
    roots = materialize(component_roots(near), "roots")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(ids, "root").select("fp", "root", "component_id"), "named")
    discard(classes, near, roots, rooted)
    return marked.join(named, "fp").select(id_col, "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component of
    ``found`` (from ``near_duplicates`` on the same rows) the row with the
    smallest id stays, ties by text hash, one of equal rows."""
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_key")
    kept = materialize(found.groupBy("root").agg(F.min(place).alias("k")).select(
        F.xxhash64("k.id", "k.text_key").alias("place")), "kept")
    keyed = docs.select(F.struct("*").alias("doc"),
                        F.xxhash64(id_col, F.xxhash64(text_or_empty(text_col))).alias("place"))
    # The window needs the join's own partitioning: texts are shuffled once.
    nth = F.row_number().over(Window.partitionBy("place").orderBy(F.lit(0)))
    return keyed.join(kept, "place", "left_semi").withColumn("nth", nth).where("nth = 1").select("doc.*")
