"""A bloom filter by size and false-positive rate, in front of an exact join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.dedup import dedup_pair
from millrace.operators.joins import broadcast_if_small

# Bits of one bitmap of Spark's bitmap functions.
BLOCK_BITS = 32_768
# The filter is sent to all tasks up to this size; beyond it the exact join runs alone.
FILTER_BYTES = 32 * 1024 * 1024


def filter_shape(entries: int, rate: float) -> tuple[int, int]:
    """Blocks and bits per entry of a filter for so many entries and that rate of false positives."""
    bits = max(1, math.ceil(-entries * math.log(rate) / math.log(2) ** 2))
    return math.ceil(bits / BLOCK_BITS), max(1, round(-math.log2(rate)))


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(blocks))


def _places(keys: list[str], hashes: int) -> list[Column]:
    """Bits of a key in its block; two hashes give all of them."""
    first, second = F.xxhash64(F.lit(1), *keys), F.xxhash64(F.lit(2), *keys)
    half = lambda h: F.pmod(h, F.lit(BLOCK_BITS))
    return [F.pmod(half(first) + n * (half(second) * 2 + 1), F.lit(BLOCK_BITS)) for n in range(hashes)]


def build(entries: DataFrame, keys: list[str], count: int, rate: float) -> DataFrame:
    """(block, bits): a bitmap for each block, built in parts that are joined by "or".

    All bits of an entry lie in one block, so a lookup needs one row. Parts are set before the shuffle.
    """
    blocks, hashes = filter_shape(count, rate)
    bits = entries.select(_block(keys, blocks).alias("block"), F.explode(F.array(*_places(keys, hashes))).alias("place"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def merged(*filters: DataFrame) -> DataFrame:
    """The filter of all entries out of filters of the same shape, such as one a day."""
    rows = filters[0]
    for other in filters[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def probed(df: DataFrame, built: DataFrame, keys: list[str], count: int, rate: float) -> DataFrame:
    """``df`` with ``maybe``: false for rows whose key is in no entry for certain."""
    blocks, hashes = filter_shape(count, rate)
    rows = df.withColumn("__block", _block(keys, blocks))
    joined = rows.join(built.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")), "__block", "left")

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("__bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (place % 8).cast("int")) == 1

    hit = F.col("__bits").isNotNull()
    for place in _places(keys, hashes):
        hit = hit & is_set(place)
    return joined.withColumn("maybe", F.coalesce(hit, F.lit(False))).select(*df.columns, "maybe")


def new_pairs(df: DataFrame, known: DataFrame, a: str, b: str, order: list[str], rate: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """The first row of each pair that isn't known, and the filter's figures (asked and measured rate).

    Rows that the filter turns away are new for certain and skip the join; the others meet the known pairs exactly.
    So the answer doesn't depend on the filter; its rate decides only how many rows the join gets. Pairs with nulls
    are pairs like others. Where the filter would be larger than the bound, all rows take the exact join.
    """
    keys = [a, b]
    entries = known.select(*keys).distinct()
    count = entries.count()
    if filter_shape(count, rate)[0] * BLOCK_BITS // 8 > FILTER_BYTES:
        marked = df.withColumn("maybe", F.lit(True))
    else:
        marked = probed(df, broadcast_if_small(build(entries, keys, count, rate)), keys, count, rate)
    fresh = marked.where(~F.col("maybe")).drop("maybe")
    other = marked.where("maybe").drop("maybe")
    side = entries.select(*[F.col(c).alias(f"__{c}") for c in keys])
    same_pair = F.col(a).eqNullSafe(F.col(f"__{a}")) & F.col(b).eqNullSafe(F.col(f"__{b}"))
    unknown = other.join(side, same_pair, "left_anti")
    sides = fresh.select(F.lit(0).alias("wrong")).unionByName(unknown.select(F.lit(1).alias("wrong")))
    measured = sides.agg(F.lit(rate).alias("asked"), F.avg("wrong").alias("measured"))
    return dedup_pair(fresh.unionByName(unknown), a, b, order), measured
