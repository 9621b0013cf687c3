"""Lookup and interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.running import has_map

# A lookup table is broadcast only when it was measured and is below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

# Over so many join keys rows without a key are dealt in a lookup that keeps them.
NULL_PARTS = 8_192


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``dim`` for broadcast after measuring it; a larger one is left to a shuffle join.

    Use it where the optimizer cannot see that a table is small, for instance after ``distinct``.
    All columns count, whatever their type, by the length of their JSON. The measurement is one row of
    sizes; no rows of the table come to the driver.
    """
    return broadcast_each_if_small([dim], max_rows, max_bytes)[0]


def broadcast_each_if_small(dims: list[DataFrame], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> list[DataFrame]:
    """:func:`broadcast_if_small` for several tables, measured in one job."""
    sizes = None
    for place, dim in enumerate(dims):
        width = F.octet_length(F.to_json(F.struct(*dim.columns), {"ignoreNullFields": "false"}))
        measured = dim.agg(
            F.lit(place).alias("place"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        )
        sizes = measured if sizes is None else sizes.unionByName(measured)
    small = {r["place"] for r in sizes.collect() if r["rows"] <= max_rows and r["bytes"] <= max_bytes}
    return [F.broadcast(d) if place in small else d for place, d in enumerate(dims)]


def measured_lookups(df: DataFrame, lookups: list[tuple[DataFrame, dict[str, str], dict[str, str]]]) -> DataFrame:
    """Left lookups one after the other, each by the way its table's size asks for.

    All tables are measured in one job. Small ones are broadcast, large ones joined by :func:`spread_lookup`.
    """
    dims = broadcast_each_if_small([dim for dim, _, _ in lookups])
    for measured, (dim, on, take) in zip(dims, lookups):
        if measured is not dim:
            df = enrich(df, measured, on, take)
        else:
            df = spread_lookup(df, dim, on, take)
    return df


def enrich(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "left") -> DataFrame:
    """Look columns up in a dimension table.

    ``on`` maps columns of ``df`` to key columns of ``dim``; ``take`` maps columns of ``dim`` to
    output names. The dimension has one row per key. Spark broadcasts it when its measured size
    allows. For two large tables use :func:`spread_lookup`.
    """
    picked = dim.select(
        *[F.col(d).alias(f"__k{i}") for i, d in enumerate(on.values())],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    condition = [F.col(left) == F.col(f"__k{i}") for i, left in enumerate(on)]
    return df.join(picked, condition, how).drop(*[f"__k{i}" for i in range(len(on))])


def spread_lookup(
    df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "left"
) -> DataFrame:
    """:func:`enrich` for two large tables where single keys of ``df`` may hold much of it.

    One pass: nothing is counted before. A key with many rows makes a large partition, which adaptive
    execution splits (``skewJoin``, forced by the session's settings), repeating the one dimension row. Rows
    without a key can't be split so, as they match nothing; where the join keeps them they get a second key
    out of a hash of their values and are dealt over all partitions.
    """
    side = dim.select(
        *[F.col(d).alias(f"__k{i}") for i, d in enumerate(on.values())],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    condition = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(on)]
    if how != "left":
        return df.join(side, condition, how).select(*df.columns, *take.values())
    missing = F.greatest(*[F.col(k).isNull() for k in on], F.lit(False))
    plain = [f.name for f in df.schema.fields if not has_map(f.dataType)]
    dealt = F.when(missing, 1 + F.pmod(F.xxhash64(*plain), F.lit(NULL_PARTS))).otherwise(0).cast("bigint")
    rows = df.withColumn("__part", dealt)
    # Zero, but not a constant: the optimizer would drop the second key for one.
    zero = F.pmod(F.xxhash64("__k0"), F.lit(1).cast("bigint"))
    joined = rows.join(side.withColumn("__kpart", zero), [*condition, F.col("__part") == F.col("__kpart")], how)
    return joined.select(*df.columns, *take.values())


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
) -> DataFrame:
    """Inner join on ``on`` where ``left_ts + lower <= right_ts <= left_ts + upper`` (seconds).

    Time is cut into stretches as long as the interval. A right row lies in one stretch, a left row
    reaches at most two, so each matching pair meets exactly once and the join key (on, stretch)
    spreads a hot key over time; adaptive execution splits what is still large. Rows without a key are
    left out before the shuffle. ``on`` columns appear once in the result; other columns of the two
    sides must not share names.
    """
    width = max(upper - lower, 1)

    def at(column: str, shift: int) -> Column:
        moved = F.unix_micros(F.col(column)) + F.lit(shift * 1_000_000)
        return F.floor(moved / F.lit(width * 1_000_000)).cast("bigint")

    keys = [*on, "__stretch"]
    reach = left.dropna(subset=on).withColumn("__stretch", F.explode(F.sequence(at(left_ts, lower), at(left_ts, upper))))
    placed = right.dropna(subset=on).withColumn("__stretch", at(right_ts, 0))
    gap = F.unix_micros(F.col(right_ts)) - F.unix_micros(F.col(left_ts))
    return (
        reach.join(placed, keys)
        .where(gap.between(lower * 1_000_000, upper * 1_000_000))
        .drop("__stretch")
    )


def prefixed(df: DataFrame, prefix: str, keep: list[str] = ()) -> DataFrame:
    """Put a prefix before every column name except those kept."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
