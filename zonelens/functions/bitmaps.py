"""A size-bounded digest of a key set, built by aggregation and tested at the scan.

Keys are hashed to one of 2^bits positions; the positions in use are kept as
blocks of 32,768 bits (Spark's bitmap functions), one row each.  A table is
reduced by joining the block of each row's key, a broadcast join of at most
2^bits / 32,768 rows of 4 KiB whatever the number of keys, and testing one bit:
a narrow step that no key of the set fails and that lets through a share of the
others equal to the share of bits in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST_BITS = 27             # 4,096 blocks, 16 MiB at most


def _position(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_digest(keys: DataFrame, key: str, bits: int = DIGEST_BITS) -> DataFrame:
    """(block, bitmap) of the non-NULL values of `key`."""
    at = keys.filter(F.col(key).isNotNull()).select(_position(key, bits).alias("at"))
    return (at.groupBy(F.bitmap_bucket_number("at").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")))


def maybe_in(rows: DataFrame, key: str, digest: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """The rows whose `key` may be in the digested set (every one that is, and few others)."""
    at = rows.filter(F.col(key).isNotNull()).withColumn("__at", _position(key, bits))
    blocks = F.broadcast(digest.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")))
    byte = "cast(conv(hex(substring(__bitmap, cast(bitmap_bit_position(__at) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    hit = F.expr(f"(shiftright({byte}, cast(bitmap_bit_position(__at) % 8 AS INT)) & 1) = 1")
    return (at.join(blocks, F.bitmap_bucket_number("__at") == F.col("__block")).filter(hit)
            .drop("__at", "__block", "__bitmap"))
