"""A filter of fixed size: it tells rows that certainly have none of some keys from rows that may.

The filter is a bit set, kept in buckets as the ``bitmap_*`` functions keep it, so that it can
be broadcast whatever the number of keys. A full filter only makes more rows be compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: 16 MiB, whatever the number of keys.
FILTER_BITS = 1 << 27


def key_bit(keys: list[str], bits: int = FILTER_BITS) -> Column:
    """Counted from 1, as the ``bitmap_*`` functions do. Null is a value of a key like any other."""
    key = F.xxhash64(F.lit(3), *[F.struct(F.col(k).isNull(), F.col(k)) for k in keys])
    return F.pmod(key, F.lit(bits)) + 1


def bit_sets(rows: DataFrame, keys: list[str], *by: str, bits: int = FILTER_BITS) -> DataFrame:
    """(by, bucket, bits) of the keys of ``rows``, a filter for each ``by``."""
    return (
        rows.select(*by, key_bit(keys, bits).alias("bit"))
        .groupBy(*by, F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )


def probed(rows: DataFrame, keys: list[str], found: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with ``_maybe``: false where the filter ``found`` (bucket, bits) has not their key."""
    place = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    hit = byte.cast("int").bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0
    # 16 MiB at most, by construction of the filter.
    return (
        rows.withColumn("_bit", key_bit(keys, bits))
        .withColumn("bucket", F.bitmap_bucket_number("_bit"))
        .join(F.broadcast(found), "bucket", "left")
        .withColumn("_maybe", F.coalesce(hit, F.lit(False)))
        .drop("bucket", "bits", "_bit")
    )


def semi_join(rows: DataFrame, keys: DataFrame, on: list[str], found: DataFrame) -> DataFrame:
    """Rows whose ``on`` is among ``keys``; ``found`` is the filter of the same keys.

    Only rows that may have a key are shuffled, should the keys be too many to broadcast.
    """
    some = probed(rows, on, found).where("_maybe").drop("_maybe")
    return some.join(keys, on, "left_semi").select(rows.columns)
