"""Bloom filters made and probed by built-in functions, of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2 ** 27 bits are 16 MB, the most that is ever broadcast. Beyond some ten million keys the filter
# lets more and more through; what comes through is then settled by a shuffle, so results stay exact.
MOST_BITS = 1 << 27
LEAST_BITS = 1 << 20


def size_for(keys: int) -> int:
    """Bits for so many keys: a power of two, 16 or more a key up to ``MOST_BITS``."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(1, keys) - 1).bit_length()))


def probes(digest: Column, bits: int) -> list[Column]:
    """Two positions for a digest in lower-case hex of 24 digits or more, one in each half of the bits."""
    half = bits // 2
    number = lambda at: F.conv(F.substring(digest, at, 12), 16, 10).cast("long") % half
    return [number(1), number(13) + half]


def bitmap(positions: DataFrame) -> DataFrame:
    """Column ``at`` (a bit position) as rows (bucket, bits) of 4 KB each."""
    return (positions.select(F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at").alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))


def hit_twice(keys: DataFrame, digest: Column, bits: int) -> DataFrame:
    """The bitmap of the bits that two rows or more probe; counts are added up before they are shuffled."""
    at = keys.select(F.explode(F.array(*probes(digest, bits))).alias("at"))
    return bitmap(at.groupBy("at").count().filter("count > 1").select("at"))


def hit(keys: DataFrame, digest: Column, bits: int) -> DataFrame:
    """The bitmap of the bits that any row probes."""
    return bitmap(keys.select(F.explode(F.array(*probes(digest, bits))).alias("at")).distinct())


def with_hits(df: DataFrame, filter_bits: DataFrame, digest: Column, bits: int, name: str) -> DataFrame:
    """``df`` with boolean ``name``: whether all bits of the row's digest are set. False is certain."""
    out, tests = df.withColumn("_probe", F.array(*probes(digest, bits))), []
    for i in range(2):
        probe = F.col("_probe")[i]
        part = F.broadcast(filter_bits.select(F.col("bucket").alias(f"_k{i}"), F.col("bits").alias(f"_b{i}")))
        out = out.join(part, F.bitmap_bucket_number(probe) == F.col(f"_k{i}"), "left")
        bit = F.bitmap_bit_position(probe)
        byte = F.conv(F.hex(F.substring(F.col(f"_b{i}"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce((F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2) == 1, F.lit(False)))
    return out.withColumn(name, tests[0] & tests[1]).drop("_probe", "_k0", "_b0", "_k1", "_b1")
