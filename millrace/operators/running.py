"""Running state per key, split in time so that one hot key never becomes one task.

A window function over ``partitionBy(key)`` puts every row of a key into one task. Here a key is cut
into stretches ("slices") of the order column. Three steps give the same numbers:

1. one row per (key, slice) with the sums and maxima of that slice - a partial aggregate, so the
   rows collapse before the shuffle;
2. a window over those few rows per key gives what each slice inherits from the earlier ones;
3. the rows meet the inherited values on (key, slice) and a window inside (key, slice) finishes.

The rows themselves are shuffled once, on (key, slice), the same number of times as with the plain
window. Keys that live in a single slice need nothing from step 2 and drop out of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

SLICE = "__slice"


@dataclass(frozen=True)
class Running:
    """One running measure.

    ``kind`` is ``sum``, ``max`` or ``last`` (the last value that isn't null); ``through`` says whether the
    current row counts.
    """

    name: str
    kind: str
    value: Column
    through: bool = False


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_by: Column,
    measures: list[Running],
    backward: bool = False,
    dealt_once: bool = False,
) -> DataFrame:
    """Add running measures over ``keys`` in ``order``.

    ``slice_by`` must not decrease along ``order``. With ``backward`` the measures run from the last
    row to the first. Sums of nothing are 0, maxima and last values of nothing are null. For ``last`` the order
    columns must tell all rows apart that have a value.

    By default the rows are computed twice, for step 1 and for step 3, which is right where step 1 collapses them. With
    ``dealt_once`` they are dealt by (key, slice) first, and both steps read that one exchange; use it where most
    slices hold few rows or the rows are dear to compute. It works if what follows uses all columns of ``df``.
    """
    inputs = {m.name: f"__in_{m.name}" for m in measures}
    carried = {m.name: f"__carry_{m.name}" for m in measures}
    rows = df.withColumn(SLICE, slice_by)
    if dealt_once:
        rows = rows.repartition(*keys, SLICE)
        plain = [f.name for f in rows.schema.fields if not has_map(f.dataType)]
    for m in measures:
        rows = rows.withColumn(inputs[m.name], m.value)

    totals = [_collapse(m, F.col(inputs[m.name]), order, backward).alias(carried[m.name]) for m in measures]
    per_slice = rows.groupBy(*keys, SLICE)
    if dealt_once:
        # It asks for all columns: an exchange of fewer ones would be a second one.
        per_slice = per_slice.agg(*totals, F.max(F.xxhash64(*plain)).alias("__every")).where(F.col("__every").isNotNull())
    else:
        per_slice = per_slice.agg(*totals)
    direction = F.desc(SLICE) if backward else F.asc(SLICE)
    earlier = Window.partitionBy(*keys).orderBy(direction)
    strictly = earlier.rowsBetween(Window.unboundedPreceding, -1)
    # Keys that pass through the window stay as they are: a filter on them would go down to one use of the exchange only.
    named = {k: f"__of_{k}" if dealt_once else k for k in (*keys, SLICE)}
    inherited = (
        per_slice.select(
            *[(F.lag(k, 0).over(earlier) if dealt_once else F.col(k)).alias(name) for k, name in named.items()],
            F.lag(SLICE).over(earlier).alias("__previous"),
            *[_fold(m, F.col(carried[m.name])).over(strictly).alias(carried[m.name]) for m in measures],
        )
        .where(F.col("__previous").isNotNull())
        .drop("__previous")
    )

    inside = Window.partitionBy(*keys, SLICE).orderBy(
        *[F.desc(c) if backward else F.asc(c) for c in order]
    )
    if dealt_once:
        out = rows.join(inherited, [F.col(k) == F.col(name) for k, name in named.items()], "left")
    else:
        out = rows.join(inherited, [*keys, SLICE], "left")
    results = []
    for m in measures:
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if m.through else -1)
        here = _fold(m, F.col(inputs[m.name])).over(frame)
        before = F.col(carried[m.name])
        if m.kind == "sum":
            both = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        elif m.kind == "last":
            both = F.coalesce(here, before)
        else:
            both = F.greatest(here, before)
        results.append(both.alias(m.name))
    return out.select(*df.columns, *results)


def _fold(m: Running, value: Column) -> Column:
    if m.kind == "sum":
        return F.sum(value)
    if m.kind == "max":
        return F.max(value)
    if m.kind == "last":
        return F.last(value, ignorenulls=True)
    raise ValueError(f"unknown running measure {m.kind}")


def _collapse(m: Running, value: Column, order: list[str], backward: bool) -> Column:
    """The measure over all rows of a slice, in any order that the rows come in."""
    if m.kind != "last":
        return _fold(m, value)
    at = F.when(value.isNotNull(), F.struct(*order))
    return (F.min_by if backward else F.max_by)(value, at)


def first_per_key(df: DataFrame, keys: list[str], order: list[str], take: list[str]) -> DataFrame:
    """Columns of the first row of each key, as an aggregate (combines map-side, no window)."""
    picked = _extreme(df, order, take, F.min, F.min_by).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("__row")[c].alias(c) for c in take])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, as an aggregate (combines map-side, no window)."""
    rest = [c for c in df.columns if c not in keys]
    picked = _extreme(df, order, rest, F.max, F.max_by).alias("__row")
    return (
        df.groupBy(*keys)
        .agg(picked)
        .select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    )


def _extreme(df: DataFrame, order: list[str], take: list[str], fold, fold_by) -> Column:
    """The row that is first or last in ``order``.

    One struct with the order columns in front carries everything once, and makes the remaining
    columns a tie-break. Maps have no order, so rows with maps are picked by a separate order struct.
    """
    others = [c for c in take if c not in order]
    if any(has_map(df.schema[c].dataType) for c in others):
        return fold_by(F.struct(*take), F.struct(*order))
    return fold(F.struct(*order, *others))


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, T.MapType)
