"""Deduplication: with retraction, newest only, exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.running import Running, first_per_key, latest_per_key, running


def retract_dedup(df: DataFrame, key: str, order: list[str], amounts: list[str], slice_by: Column) -> DataFrame:
    """Every row, and for each row that a later one of the same key replaces its negation.

    The negated row keeps the time of the row it takes back, so it corrects the old window. ``sign``
    tells the two apart. ``order`` must be a total order up to equal rows.
    """
    later = Running("__later", "sum", F.lit(1), through=False)
    seen = running(df, [key], order, slice_by, [later], backward=True)
    signs = F.when(F.col("__later") > 0, F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    signed = seen.select(*df.columns, F.explode(signs).alias("sign"))
    return signed.select(
        *[(F.col(c) * F.col("sign")).cast(df.schema[c].dataType).alias(c) if c in amounts else F.col(c) for c in df.columns],
        "sign",
    )


def newest_only(df: DataFrame, key: str, version: str, arrival: list[str], slice_by: Column) -> DataFrame:
    """Rows whose version exceeds every version of the key that arrived before.

    Only the first arrival of each (key, version) can pass, so repeats collapse in an aggregate before
    anything is put in order.
    """
    rest = [c for c in df.columns if c not in (key, version)]
    firsts = first_per_key(df, [key, version], arrival, rest)
    best = Running("__best", "max", F.col(version), through=False)
    seen = running(firsts, [key], arrival, slice_by, [best])
    return seen.where(F.col("__best").isNull() | (F.col(version) > F.col("__best"))).select(*df.columns)


def latest_held(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Only the newest row per key, as a hold-and-emit timer would give at the end of its wait."""
    return latest_per_key(df, [key], order)


def distinct_records(df: DataFrame) -> DataFrame:
    """Each different record once."""
    return df.dropDuplicates()


def dedup_pair(df: DataFrame, a: str, b: str, order: list[str]) -> DataFrame:
    """The first row of each pair of values. Exact, where a bloom filter would also drop new pairs."""
    rest = [c for c in df.columns if c not in (a, b)]
    return first_per_key(df, [a, b], order, rest).select(*df.columns)
