"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every id with an edge to another id; ``edges`` has columns a, b (long).

    Each round every node follows the neighbour (or itself) of the smallest round-salted hash, and the
    edges are redrawn between the nodes followed. Components stay whole and shrink by a fixed share per
    round on average, whatever their shape, so the rounds grow with the logarithm of the largest one.
    A round is one aggregate with a map-side half and two joins that adaptive execution splits at hot
    nodes; neighbours are never gathered. The component's name is its smallest id. Repeated edges are
    allowed; loops and rows with a null end say nothing and are left out; no edges give no rows.
    """
    live = saved(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "edges"
    )
    followed: list[DataFrame] = []
    turn = 0
    while not live.isEmpty():
        ends = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = ends.union(live.select("a", F.col("a").alias("b"))).union(live.select(F.col("b").alias("a"), "b"))
        rank = F.struct(F.xxhash64(F.col("b"), F.lit(turn)).alias("h"), F.col("b").alias("to"))
        step = saved(both.groupBy("a").agg(F.min(rank).alias("m")).select(F.col("a").alias("id"), "m.to"), "follow")
        followed.append(step)
        left = step.select(F.col("id").alias("a"), F.col("to").alias("ta"))
        right = step.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        live = saved(
            live.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b")).where("a <> b").distinct(),
            "edges",
        )
        turn += 1
    if not followed:
        return live.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    labels = followed[0]
    for step in followed[1:]:
        # A component that is down to one node takes part in no further round and keeps its name.
        jump = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        labels = labels.join(jump, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
    labels = saved(labels, "labels")
    # Every node of the component is in ``labels``, its smallest id too.
    names = labels.groupBy("to").agg(F.min("id").alias("component_id"))
    return labels.join(names, "to").select("id", "component_id")
