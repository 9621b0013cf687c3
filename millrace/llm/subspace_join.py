"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.components import connected_components
from millrace.llm.tables import arrow, saved, ship

COSINE = 0.9
BLOCKS = 4
# Vectors of each side of a tile, and rows of a tile that are compared at a time.
TILE_ROWS = 16_384
AT_ONCE = 256
PAIRS_AT_ONCE = 50_000
SLACK = 1e-9  # rounding of squared distances


@lru_cache(maxsize=16)
def rotation(d: int) -> np.ndarray:
    """A fixed random rotation, which spreads any direction evenly over the blocks."""
    q, r = np.linalg.qr(np.random.RandomState(d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def plan(d: int, cosine: float) -> list[tuple[slice, float]]:
    """The blocks of d coordinates and each one's share of the squared distance, by its width.

    Unit vectors with at least this cosine have a squared distance of 2 - 2 cosine at most. If it were larger
    than its budget in every block, it would be larger in all: so some block is within its budget.
    """
    edges = np.linspace(0, d, min(BLOCKS, d) + 1).astype(int)
    whole = 2 - 2 * cosine
    return [(slice(a, b), whole * (b - a) / d + SLACK) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _cells(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(pa.compute.list_value_length(batch["vec"]).to_pylist(), np.int64)
            cells: list = [None] * len(batch)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x = _matrix(batch["vec"].take(pa.array(at)))
                x = x / np.linalg.norm(x, axis=1, keepdims=True) @ rotation(int(d))
                first = np.stack([np.floor(x[:, s.start] / np.sqrt(budget)) for s, budget in plan(int(d), cosine)], axis=1)
                for i, c in zip(at, first.astype(int).tolist(), strict=True):
                    cells[i] = c
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n"], batch["vec"], pa.array(sizes), pa.array(cells, pa.list_(pa.int32()))],
                names=["id", "n", "vec", "d", "cells"],
            )

    return run


def _tile(cosine: float):
    """All links between a tile's two sides that are first found in this tile's block."""

    def run(table: pa.Table) -> pa.Table:
        d, block, same = table["d"][0].as_py(), table["block"][0].as_py(), table["same"][0].as_py()
        table = table.sort_by("id")
        ids, weight = table["id"].to_numpy(), table["n"].to_numpy()
        x = _matrix(table["vec"])
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        y = x / norms[:, None] @ rotation(d)
        parts = plan(d, cosine)
        (span, budget), starts = parts[block], [s.start for s, _ in parts]
        budgets = np.array([b for _, b in parts])
        side = np.array(table["side"].to_pylist())
        left = np.flatnonzero(side != "right")
        right = np.flatnonzero(side != "left")
        # One product gives minus half the squared distance in the block.
        half = np.einsum("ij,ij->i", y[:, span], y[:, span])[:, None] / 2
        ones = np.ones_like(half)
        a = np.hstack([y[:, span], half, ones]).astype(np.float32)[left]
        b = np.hstack([y[:, span], -ones, -half]).astype(np.float32)[right].T
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        for at in range(0, len(left), AT_ONCE):
            i, j = np.nonzero(a[at : at + AT_ONCE] @ b >= -budget / 2 - 1e-5)
            i, j = left[at + i], right[j]
            if same:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), PAIRS_AT_ONCE):
                p, q = i[k : k + PAIRS_AT_ONCE], j[k : k + PAIRS_AT_ONCE]
                near = np.einsum("ij,ij->i", x[p], x[q]) / (norms[p] * norms[q]) >= cosine
                p, q = p[near], q[near]
                within = np.add.reduceat((y[p] - y[q]) ** 2, starts, axis=1) <= budgets
                # A pair within several blocks' budgets counts in the first of them alone.
                mine = within.argmax(axis=1) == block
                p, q = p[mine & within.any(axis=1)], q[mine & within.any(axis=1)]
                links += np.bincount(p, weight[q], len(ids)).astype(np.int64) + np.bincount(q, weight[p], len(ids)).astype(np.int64)
                while len(p):
                    low = np.minimum(root[p], root[q])
                    open_ = (root[p] != low) | (root[q] != low)
                    p, q, low = p[open_], q[open_], low[open_]
                    np.minimum.at(root, root[p], low)
                    np.minimum.at(root, root[q], low)
                    root = root[root]
        while (root != root[root]).any():
            root = root[root]
        hit = np.flatnonzero(links)
        return pa.table({"id": ids[hit], "links": links[hit], "root": ids[root[hit]]})

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per vector: vec_id, n_links (other vectors linked directly), component_id and kept.

    ``vectors`` needs vec_id and embedding (array of numbers); other columns are ignored. Vectors whose
    cosine, in double precision, is ``cosine`` or more are linked; kept is vec_id = component_id, the smallest
    id that links reach.

    1. Equal arrays form a class with a count; one of each goes on.
    2. Unit vectors are rotated and split into blocks; each block has its share of the squared distance as its
       budget, so a linked pair is within it in at least one block.
    3. Each block is range-joined: cells along its first coordinate, one budget radius wide, so a vector
       meets its own cell and the one below. Cells are cut into tiles of bounded size, so a cell that holds
       a third of all vectors is dealt over many tasks. In a tile one matrix product finds the pairs within the
       budget, exact cosines confirm them, and a pair is counted in its first block only. A tile returns
       counts and a spanning forest of its vectors, never its pairs.
    4. Counts are added up and the forests' edges give the components.

    This is exact. Vectors without structure lie in a few cells, so most pairs of a block do meet and the work
    grows with the square of the number of vectors; it shrinks with tighter thresholds and clustered data.

    Null, zero and non-finite vectors, empty arrays and ones with null components link with nothing, as do
    vectors of different lengths among each other. A null id is returned, linked with nothing and kept.
    Repeated rows are vectors of the same id and count as links of each other. No rows give no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vec"))
    sane = (
        (F.size("vec") > 0)
        & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
        & F.exists("vec", lambda v: v != 0)
    )
    valid = saved(rows.where(F.col("vec_id").isNotNull() & F.coalesce(sane, F.lit(False))), "vectors")
    classes = saved(valid.groupBy("vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "classes")
    placed = saved(
        arrow(classes.select("id", "n", "vec"), _cells(cosine), classes.select("id", "n", "vec", F.lit(0).cast("long").alias("d"),
              F.array(F.lit(0)).alias("cells")).schema), "cells",
    )
    stays = F.posexplode("cells").alias("block", "cell")
    homes = placed.select("id", "n", "vec", "d", stays)
    tiles_of = F.ceil(F.col("count") / TILE_ROWS).cast("int")
    # Rows of a cell: cells lie along one coordinate of unit vectors, so their number is bounded by the
    # threshold (2 / radius), not by the data.
    counts = placed.select("d", stays).groupBy("d", "block", "cell").count().select("d", "block", "cell", tiles_of.alias("parts"))
    counts = F.broadcast(saved(counts, "cell-counts"))
    own = homes.join(counts, ["d", "block", "cell"])
    above = counts.select("d", "block", (F.col("cell") - 1).alias("cell"), F.col("parts").alias("parts_above"))
    below = counts.select("d", "block", (F.col("cell") + 1).alias("cell"), F.col("parts").alias("parts_below"))
    own = own.withColumn("part", F.pmod(F.xxhash64("id"), "parts")).join(F.broadcast(above), ["d", "block", "cell"], "left").join(
        F.broadcast(below), ["d", "block", "cell"], "left"
    )

    def tiles(cell, same, i, j, side):
        return F.struct(cell.alias("cell"), F.lit(same).alias("home"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.alias("side"))

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    part = F.col("part")
    spread = F.concat(
        # Its own cell: pairs of parts, each pair of parts once.
        F.transform(
            upto(F.col("parts")),
            lambda o: tiles(F.col("cell"), True, F.least(part, o), F.greatest(part, o),
                            F.when(part == o, "both").when(part < o, "left").otherwise("right")),
        ),
        # As the lower side of a pair with the cell above, and as the upper side in the cell below.
        F.transform(upto(F.coalesce("parts_above", F.lit(0))), lambda o: tiles(F.col("cell"), False, part, o, F.lit("left"))),
        F.transform(upto(F.coalesce("parts_below", F.lit(0))), lambda o: tiles(F.col("cell") - 1, False, o, part, F.lit("right"))),
    )
    dealt = own.select("id", "n", "vec", "d", "block", F.explode(spread).alias("t")).select(
        "id", "n", "vec", "d", "block", "t.cell", "t.home", "t.i", "t.j", "t.side", (F.col("t.home") & (F.col("t.i") == F.col("t.j"))).alias("same")
    )
    found = saved(
        dealt.groupBy("d", "block", "cell", "home", "i", "j").applyInArrow(_tile(cosine), "id long, links long, root long"), "tile-links"
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    names = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = classes.join(links, "id", "left").join(names, "id", "left").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    linked = valid.join(per_class, "vec").select("vec_id", "n_links", "component_id")
    rest = rows.where(F.col("vec_id").isNull() | ~F.coalesce(sane, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
