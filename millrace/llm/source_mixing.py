"""Interleaving sources to target weights by Pfair scheduling of blocks."""

from __future__ import annotations

import heapq
from functools import reduce
from math import gcd, sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.tables import saved, whole_row

BLOCK_ROWS = 16
# Slots of one period at most: the weights' resolution times the number of sources.
MOST_SLOTS = 5_000_000


def tempered_weights(docs: DataFrame) -> dict[str | None, int]:
    """Integer target weights by source: 1,000 times the square root of its size over the largest one's, or so
    many times less that a period of all sources has MOST_SLOTS at most.

    One row per source reaches the driver; sources are names that people gave, not data.
    """
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).count().collect()
    top = max((r["count"] for r in sizes), default=1)
    shares = {r["source"]: sqrt(r["count"] / top) for r in sizes}

    def weights(most: float) -> dict[str | None, int]:
        return {s: max(1, int(most * share)) for s, share in shares.items()}

    fine = weights(1000)
    if sum(fine.values()) <= MOST_SLOTS:
        return fine
    # Each weight is at most its part of what is left beside one slot a source, and that one.
    return weights(max(0, MOST_SLOTS - len(shares)) / sum(shares.values()))


def period(weights: dict[str | None, int]) -> tuple[int, list[tuple[str | None, int, int, int]]]:
    """The number of slots of a period, and (source, weight, block, slot) for each of its slots.

    With weights u that add up to q, block j of a source (from 0) is released at slot floor(j q / u) and due
    before slot ceil((j + 1) q / u). In each slot the released block that is due first is placed. The weights
    fill every slot, so no deadline is missed, and at any time each source has less than one block more or
    less than its share. After q slots everything starts again. This reads the weights alone.
    """
    shared = reduce(gcd, weights.values(), 0) or 1
    units = {s: u // shared for s, u in weights.items() if u > 0}
    slots = sum(units.values())
    if slots > MOST_SLOTS:
        raise ValueError(f"{slots} slots in a period: use coarser weights")
    order = {s: i for i, s in enumerate(sorted(units, key=lambda s: (s is not None, s or "")))}
    waiting = [(0, order[s], s, 0) for s in units]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str | None, int]] = []
    placed = []
    for t in range(slots):
        while waiting and waiting[0][0] <= t:
            _, rank, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * slots // units[s]), rank, s, j))
        _, rank, s, j = heapq.heappop(ready)
        placed.append((s, units[s], j, t))
        if j + 1 < units[s]:
            heapq.heappush(waiting, ((j + 1) * slots // units[s], rank, s, j + 1))
    return slots, placed


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source) with each row's number within its source by doc_id, from 0.

    The rows are dealt by ranges of (source, doc_id); rows are numbered within each range, and a source's
    ranges are added up, so a source with most of the rows is numbered by as many tasks as it has ranges.
    """
    ranges = saved(rows.repartitionByRange(F.col("source"), F.col("doc_id")).withColumn("range", F.spark_partition_id()), "ranges")
    own = ranges.withColumn("n", F.row_number().over(Window.partitionBy("source", "range").orderBy("doc_id")) - 1)
    sizes = ranges.groupBy("source", "range").count()
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return own.join(starts.withColumn("source", _key(F.col("source"))).withColumnRenamed("source", "key").withColumnRenamed("range", "r"),
                    (_key(F.col("source")) == F.col("key")) & (F.col("range") == F.col("r"))).select(
        "doc_id", "source", (F.col("start") + F.col("n")).alias("number"))


def mixed(docs: DataFrame, weights: dict[str | None, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per document: doc_id, source, number (within the source), block, release, deadline and slot.

    ``docs`` needs doc_id and source; other columns are ignored. ``weights`` are integers by source (None for
    rows without one); a source that is not named has no target, and its rows get no slot (null). Without
    weights they are tempered by size. Every row of a named source has a slot: rows in the order of (slot,
    number) are the mixture. As long as all sources last, each has less than one block more or less than its
    share at any slot; when one has run out its slots stay empty and the others go on. Repeated rows and null
    ids (first) are numbered like others; no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"))
    weights = tempered_weights(rows) if weights is None else weights
    spark = docs.sparkSession
    slots, placed = period(weights)
    plan = spark.createDataFrame(placed, "planned string, weight long, k long, at long").withColumn("planned", _key(F.col("planned")))
    # The plan holds one row per slot of a period: its size is set by the weights, not by the data.
    shares = F.broadcast(plan.select("planned", "weight").distinct())
    numbered = ranked(rows).withColumn("key", _key(F.col("source"))).withColumn("block", F.floor(F.col("number") / block_rows))
    planned = numbered.join(shares, F.col("key") == F.col("planned"), "left").drop("planned")
    turn = F.floor(F.col("block") / F.col("weight"))
    full = planned.withColumn("turn", turn).withColumn("k", F.col("block") - F.col("turn") * F.col("weight"))
    placed_rows = full.join(F.broadcast(plan.select("planned", F.col("k").alias("block_k"), "at")),
                            (F.col("key") == F.col("planned")) & (F.col("k") == F.col("block_k")), "left")
    q = F.lit(slots)
    return placed_rows.select(
        "doc_id",
        "source",
        "number",
        "block",
        F.floor(F.col("block") * q / F.col("weight")).alias("release"),
        F.ceil((F.col("block") + 1) * q / F.col("weight")).alias("deadline"),
        (F.col("turn") * q + F.col("at")).alias("slot"),
    )


def in_mixture_order(docs: DataFrame, weights: dict[str | None, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All documents, with their columns, dealt and sorted by their place in the mixture.

    Parts follow each other in the order of slots, and rows within a part, so files written from this hold the
    mixture in order. Rows without a slot (their source has no target, or they have no id) come last.
    """
    places = mixed(docs, weights, block_rows).where("doc_id IS NOT NULL").select(
        F.col("doc_id").alias("placed_id"), F.struct(F.col("slot").isNull().alias("last"), "slot", "number").alias("place")
    ).dropDuplicates(["placed_id"])
    rows = docs.select(whole_row(docs).alias("document"), F.col("doc_id").alias("own_id"))
    ordered = rows.join(places, F.col("own_id") == F.col("placed_id"), "left").select(
        "document", F.coalesce(F.col("place.last"), F.lit(True)).alias("last"), "place.slot", "place.number"
    )
    keys = ["last", "slot", "number"]
    return ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("document.*")
