"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

A plain shuffle by a random key gives shards whose sizes vary. Here every input partition is told how many
of its rows go to which shard, and those counts are drawn as a uniform permutation of all rows would give
them: the matrix has the row sums of the partitions and the column sums of the shards. Each partition then
permutes its rows and hands them out by its counts, and each shard permutes what it received.

Everything is column expressions. The draws are functions of a seed and of the matrix cell, so a task that
is run again draws the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.tables import let, saved, whole_row
from millrace.operators.running import Running, running

SEED = 20_240_229
# Children of a node of the draws' tree, as bits. No draw sees more than so many nodes at once.
FAN_BITS = 6
# Rows of a block; a shard is permuted block by block.
BLOCK_ROWS = 4_096
# Tries of one draw. Each is accepted with a probability of more than 0.6.
TRIES = 80

# Logarithms of the first factorials; above them a series is exact to the last digits.
LOG_FACTORIALS = [math.lgamma(x + 1) for x in range(16)]
FAR = 1_024


def _uniform(*key: Column) -> Column:
    """A number strictly between 0 and 1 that is a function of the key."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) * F.lit(2.0**-53)


def _log_factorial(x: Column) -> Column:
    d = x.cast("double")
    series = (d + 0.5) * F.log(d) - d + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * d) - 1 / (360 * d * d * d) + 1 / (1260 * F.pow(d, F.lit(5)))
    return F.when(x < len(LOG_FACTORIALS), F.get(F.array(*map(F.lit, LOG_FACTORIALS)), x.cast("int"))).otherwise(series)


def _log_factorial_gap(a: Column, b: Column) -> Column:
    """log(a!) - log(b!) without the loss of digits that the difference of two large logarithms has."""
    x, y = a.cast("double"), b.cast("double")
    near = (y + 0.5) * F.log1p((x - y) / y) + (x - y) * (F.log(x) - 1) + (1 / x - 1 / y) / 12
    return F.when((a >= FAR) & (b >= FAR), near).otherwise(_log_factorial(a) - _log_factorial(b))


def hypergeometric(total: Column, good: Column, draws: Column, *key: Column) -> Column:
    """How many of ``draws`` rows taken out of ``total`` are among the ``good`` ones: one draw per key.

    Ratio of uniforms: a point under a table mountain around the mean is taken if it lies under the
    distribution, too. The first of the tries that is accepted counts. All arguments are bigint.
    """
    bad = total - good
    least, most = F.greatest(F.lit(0).cast("bigint"), draws - bad), F.least(good, draws)
    n, k, d = total.cast("double"), good.cast("double"), draws.cast("double")
    mean = d * k / n
    variance = mean * (1 - k / n) * (n - d) / F.greatest(n - 1, F.lit(1.0))
    width = F.lit(2 * math.sqrt(2 / math.e)) * F.sqrt(variance + 0.5) + F.lit(3 - 2 * math.sqrt(3 / math.e))
    top = F.floor((d + 1) * (k + 1) / (n + 2)).cast("bigint")

    def sampled(p: Column) -> Column:
        def log_ratio(z: Column) -> Column:
            m = p["top"]
            return -(
                _log_factorial_gap(z, m) + _log_factorial_gap(good - z, good - m)
                + _log_factorial_gap(draws - z, draws - m) + _log_factorial_gap(bad - draws + z, bad - draws + m)
            )

        def tried(t: Column) -> Column:
            x = _uniform(*key, t, F.lit(0))
            w = p["mean"] + 0.5 + p["width"] * (_uniform(*key, t, F.lit(1)) - 0.5) / x
            inside = (w >= p["least"]) & (w < p["most"] + 1)
            return let(
                F.when(inside, F.floor(w).cast("bigint")),
                lambda z: F.when(z.isNotNull() & (2 * F.log(x) <= log_ratio(z)), z),
            )

        first = F.aggregate(
            F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("bigint"), lambda found, t: F.coalesce(found, tried(t))
        )
        return F.coalesce(first, p["top"])

    shape = F.struct(
        mean.alias("mean"), width.alias("width"), least.alias("least"), most.alias("most"),
        F.least(F.greatest(top, least), most).alias("top"),
    )
    return F.when(least >= most, least).otherwise(let(shape, sampled))


def _row_of_matrix(left: Column, n: Column, *key: Column) -> Column:
    """``n`` rows dealt over the shards, of which ``left`` gives the free places: one draw after the other."""
    none = F.array().cast("array<bigint>")
    start = F.struct(
        n.alias("need"), F.aggregate(left, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"), none.alias("out")
    )

    def next_shard(s: Column, j: Column) -> Column:
        good = F.get(left, j)
        return let(
            F.struct(s.alias("s"), hypergeometric(s["total"], good, s["need"], *key, j).alias("x"), good.alias("good")),
            lambda v: F.struct(
                (v["s"]["need"] - v["x"]).alias("need"),
                (v["s"]["total"] - v["good"]).alias("total"),
                F.concat(v["s"]["out"], F.array(v["x"])).alias("out"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(left) - 1), start, next_shard, lambda s: s["out"])


def _rows_of_matrix(children: Column, free: Column, level: int, seed: int) -> Column:
    """The children's rows of the matrix; together they take what is free."""
    none = F.array().cast("array<struct<part:bigint,cells:array<bigint>>>")
    start = F.struct(free.alias("free"), none.alias("out"))

    def next_child(s: Column, child: Column) -> Column:
        cells = _row_of_matrix(s["free"], child["n"], F.lit(seed), F.lit(level), child["part"])
        return let(
            F.struct(s.alias("s"), cells.alias("cells"), child["part"].alias("part")),
            lambda v: F.struct(
                F.zip_with(v["s"]["free"], v["cells"], lambda a, b: a - b).alias("free"),
                F.concat(v["s"]["out"], F.array(F.struct(v["part"].alias("part"), v["cells"].alias("cells")))).alias("out"),
            ),
        )

    return F.aggregate(children, start, next_child, lambda s: s["out"])


def communication_matrix(counts: DataFrame, sizes: list[int], seed: int = SEED) -> DataFrame:
    """(part, cells): how many rows of each part go to each shard, as a uniform shuffle would have it.

    ``counts`` has part (bigint, not negative) and n (bigint), one row per part; ``sizes`` are the shards'
    sizes and sum to all n. The parts are leaves of a tree: the counts of a node are dealt over its at most
    64 children, level by level, so parts grow freely and no task sees more than one node's children.
    """
    spark = counts.sparkSession
    last = counts.agg(F.max("part")).first()[0]
    levels = 1
    while last is not None and last >> (FAN_BITS * levels):
        levels += 1
    free = F.array(*[F.lit(s).cast("bigint") for s in sizes])
    nodes = spark.range(1).select(F.col("id").alias("parent"), free.alias("free"))
    for level in reversed(range(levels)):
        children = (
            counts.groupBy(F.shiftright("part", FAN_BITS * level).alias("part"))
            .agg(F.sum("n").alias("n"))
            .groupBy(F.shiftright("part", FAN_BITS).alias("parent"))
            .agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("children"))
        )
        dealt = nodes.join(children, "parent").select(
            F.explode(_rows_of_matrix(F.col("children"), F.col("free"), level, seed)).alias("row")
        )
        nodes = dealt.select(F.col("row.part").alias("parent"), F.col("row.cells").alias("free"))
    return nodes.select(F.col("parent").alias("part"), F.col("free").alias("cells"))


def even_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def sharded(frame: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """Every row with its shard (int, from 0) and its slot (bigint, gapless from 0 within the shard).

    Law: the shards' sizes are at most one apart, the first ones larger, and all orders of the rows are
    equally likely (up to the quality of the hash). Columns of the caller named shard or slot are replaced;
    other names can't clash. Values don't matter: null ids, equal rows and long texts are rows like others.
    An empty table gives no rows.

    Rows are written once, sorted at random within their partition and numbered; their counts give the
    matrix; one exchange by (shard, block) carries them over. A shard's blocks are drawn at random for each
    row, so blocks hold some 4,096 rows whatever the input holds, and a slot is the number of rows in
    earlier blocks plus the place in the own one.
    """
    place = F.monotonically_increasing_id()
    first = frame.select(whole_row(frame).alias("row"), place.alias("place"))
    mixed = first.withColumn("u", F.xxhash64(F.lit(seed), F.lit(1), "place")).sortWithinPartitions("u")
    rows = saved(
        mixed.select(
            "row",
            F.shiftright("place", 33).alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("number"),
            F.xxhash64(F.lit(seed), F.lit(2), "place").alias("again"),
        ),
        "sharding-rows",
    )
    counts = saved(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "sharding-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (shards * BLOCK_ROWS)))

    upto = F.transform(
        F.sequence(F.lit(1), F.size("cells")),
        lambda n: F.aggregate(F.slice("cells", F.lit(1), n), F.lit(0).cast("bigint"), lambda a, b: a + b),
    )
    matrix = saved(communication_matrix(counts, even_sizes(total, shards), seed).select("part", upto.alias("upto")), "sharding-matrix")
    shard = F.size(F.filter("upto", lambda end: end <= F.col("number")))
    order = F.shiftrightunsigned("again", 1)
    block = F.shiftright(F.shiftright(order, 31) * blocks, 32)
    dealt = rows.join(matrix, "part").select(
        "row", shard.alias("shard"), block.alias("block"), order.alias("order"), "again"
    )

    held = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = running(held, ["shard"], ["block"], F.floor(F.col("block") / 1_024), [Running("start", "sum", F.col("n"))])
    starts = saved(starts.select("shard", "block", "start"), "sharding-blocks")
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("order", "again"))
    placed = dealt.withColumn("inside", inside.cast("bigint")).join(starts, ["shard", "block"])
    own = [F.col("row")[c].alias(c) for c in frame.columns if c not in ("shard", "slot")]
    return placed.select(*own, "shard", (F.col("start") + F.col("inside") - 1).alias("slot"))
