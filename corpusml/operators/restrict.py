"""Restriction of a table of long rows to a table of listed keys.

A manifest too big to broadcast makes Spark shuffle both sides of the join,
texts included.  Here two bitmaps of the listed keys' hashes (a Bloom filter
with a bitmap of its own for each hash) are broadcast instead, and rows of
keys that are surely not listed go where they are read.  The bitmaps have a
fixed size whatever the number of keys; more keys only let more rows pass,
which the join removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of each bitmap: 16 MB at most (4 KB for each 32768 bits that hold a key).
FILTER_BITS = 1 << 27
SEEDS = (11, 13)


def _free(df: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def _has_bit(bits: Column, position: Column) -> Column:
    own = F.substring(bits, (position / 8).cast("int") + 1, 1)
    return F.getbit(F.conv(F.hex(own), 16, 10).cast("long"), (position % 8).cast("int")) == 1


def likely_listed(df: DataFrame, listed: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``listed[key]``, and some
    others: nothing of ``df`` is shuffled.  A null key may pass."""
    out = df
    keys = listed.select(F.col(key).cast(df.schema[key].dataType).alias("key"))
    for seed in SEEDS:
        bucket, bitmap = _free(out, "filter_bucket"), _free(out, "filter_bits")

        def place(column: str, seed=seed) -> Column:
            return F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(bits))

        maps = keys.select(F.bitmap_bucket_number(place("key")).alias(bucket),
                           F.bitmap_bit_position(place("key")).alias("position")).groupBy(bucket).agg(
            F.bitmap_construct_agg("position").alias(bitmap))
        met = out.withColumn(bucket, F.bitmap_bucket_number(place(key))).join(F.broadcast(maps), bucket)
        out = met.where(_has_bit(F.col(bitmap), F.bitmap_bit_position(place(key)))).select(*df.columns)
    return out


def restrict(df: DataFrame, listed: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``listed[key]``: rows that pass
    ``likely_listed`` are joined with the keys.  Repeated rows stay, repeated
    keys count once, null keys match nothing; other columns pass through."""
    keys = listed.select(F.col(key).cast(df.schema[key].dataType).alias(key))
    return likely_listed(df, listed, key, bits).join(keys, key, "left_semi").select(*df.columns)
