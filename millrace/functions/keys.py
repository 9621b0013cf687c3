"""Row keys, hash buckets and maps as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_key(*fields: Column, separator: str = "_", hash_fields: bool = False, hash_key: bool = False) -> Column:
    """Fields joined by a separator; single fields or the whole key can be replaced by their md5."""
    parts = [F.md5(f.cast("string")) if hash_fields else f.cast("string") for f in fields]
    key = F.concat_ws(separator, *parts)
    return F.md5(key) if hash_key else key


def hash_bucket(value: Column, buckets: int) -> Column:
    """Last three hex digits of the md5 modulo ``buckets``, as four digits."""
    digits = F.conv(F.right(F.md5(value.cast("string")), F.lit(3)), 16, 10).cast("int")
    return F.lpad((digits % buckets).cast("string"), 4, "0")


def keep_keys(entries: Column, wanted: Column) -> Column:
    """Map entries whose key appears in an array."""
    return F.map_filter(entries, lambda k, _: F.array_contains(wanted, k))


def map_text(entries: Column) -> Column:
    """``k=v`` pairs in key order, joined by commas; null stays null."""
    pairs = F.transform(
        F.map_entries(entries),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
    )
    return F.array_join(F.array_sort(pairs), ",")
