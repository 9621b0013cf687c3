"""The trie of conversation prefixes, by digests of fixed-length blocks of turns.

Conversations are grouped by the digest of all turns through block 1, 2, 3, ... of four turns each. Inside a
block the turns are looked at one by one only where the conversations that agree before the block go on in
different ways; elsewhere the block's turns are nodes with the block's members. Digests of a prefix are sums
over its turns, so they are running sums and a conversation of any length is cut into slices; nothing walks
down the trie level by level, and no group of conversations or turns is gathered.

What a node's subtree adds up to is found through its members. Every node belongs to its smallest member,
which therefore owns the last part of its own path. A node's subtree consists of what its members own at its
depth or deeper, so subtree sums are sums over members of sums along their paths from the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.tables import arrow, saved
from millrace.operators.running import Running, running

BLOCK = 4
# Blocks of a conversation that one task puts in order; ids in one pack of a node's list.
SLICE, PACK = 256, 1_024
LANES = ["l0", "l1", "l2", "l3"]
NOTHING = hashlib.sha256(b"").hexdigest()

# Conversations share the first turns of the first one of their five, up to eight of them.
FAMILY, SHARED = 5, 9


def _digest() -> Column:
    """Of role and text; the role's length in front keeps the two apart."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(c, p, digest, size): every turn's number p in its conversation, from 1, and its text's bytes.

    By turn, without one first; equal ones by their digest. Turns are dealt by ranges of (conversation,
    turn, digest), so a long conversation lies in many tasks; each numbers its part, and the parts' sizes
    shift the numbers.
    """
    order = ["c", "turn", "digest"]
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").cast("long").alias("turn"),
        _digest().alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
    )
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = saved(
        dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "trie-turns"
    )
    parts = rows.groupBy("c", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # One row per conversation and task that holds some of it.
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("c", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return rows.join(shift, ["c", "part"]).select("c", (F.col("at") + F.col("shift")).alias("p"), "digest", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (c), and their turns after the first ones were taken from the family's first.

    Turns have c, q (from 1), digest and size.
    """
    lengths = turns.groupBy("c").agg(F.max("p").alias("length"))
    shared = F.pmod(F.crc32(F.col("c").cast("string")), F.lit(SHARED))
    convs = lengths.select("c", (F.col("c") - F.col("c") % FAMILY).alias("base"), shared.alias("h"))
    bases = lengths.select(F.col("c").alias("base"), "length")
    convs = convs.join(bases, "base", "left").select(
        "c", "base", "h", F.least(F.coalesce("length", F.lit(0)), "h").alias("taken")
    )
    convs = saved(convs, "trie-conversations")
    heads = turns.where(F.col("p") < SHARED).withColumnRenamed("c", "base")
    taken = convs.join(heads, "base").where("p <= h").select("c", F.col("p").alias("q"), "digest", "size")
    own = turns.join(convs, "c").where("p > h").select("c", (F.col("taken") + F.col("p") - F.col("h")).alias("q"), "digest", "size")
    return convs.select("c"), taken.unionByName(own)


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.struct(depth.cast("long").alias("d"), *[v.alias(n) for v, n in zip(lanes, LANES)])


def _blocks(turns: DataFrame) -> DataFrame:
    """(c, k, before, end, steps, last): each conversation's blocks, with the nodes they pass.

    A node's key is its depth and four sums of 32 bits of its turns' hashes, each of digest and place.
    ``before`` is the key ahead of the block, ``end`` that behind it, ``steps`` the up to four in between.
    """
    hashes = [F.xxhash64(F.lit(seed), "q", "digest") for seed in (1, 2)]
    halves = [h for v in hashes for h in (F.shiftrightunsigned(v, 32), v.bitwiseAND(F.lit(0xFFFFFFFF)))]
    lanes = turns.select("c", "q", "size", *[v.alias(n) for v, n in zip(halves, LANES)])
    packed = lanes.groupBy("c", F.floor((F.col("q") - 1) / BLOCK).alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("q", "size", *LANES))).alias("turns"), *[F.sum(n).alias(n) for n in LANES]
    )
    cut = F.floor(F.col("k") / SLICE)
    ahead = running(packed, ["c"], ["k"], cut, [Running(f"b{n}", "sum", F.col(n)) for n in LANES])
    before = [F.col(f"b{n}") for n in LANES]

    def upto(i: Column, lane: str, start: Column) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), i), start, lambda a, t: a + t[lane])

    step = lambda i: F.struct(
        _key(F.col("k") * BLOCK + i, [upto(i, n, b) for n, b in zip(LANES, before)]).alias("key"),
        F.get("turns", i - 1)["size"].alias("size"),
    )
    steps = ahead.select(
        "c", "k", _key(F.col("k") * BLOCK, before).alias("before"),
        F.transform(F.sequence(F.lit(1), F.size("turns")), step).alias("steps"),
    )
    return saved(steps.withColumn("end", F.element_at("steps", -1)["key"]), "trie-blocks")


def _nodes(blocks: DataFrame) -> DataFrame:
    """(key, conv_id, n_convs, k, parent, size, path) of every node below the root."""
    groups = blocks.groupBy("k", "before", "end").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c"))
    siblings = groups.groupBy("k", "before").agg(F.count(F.lit(1)).alias("siblings"))
    stepped = groups.join(siblings, ["k", "before"]).join(blocks.select("c", "k", "steps"), ["c", "k"])
    flat = saved(
        stepped.select("c", "k", "n", (F.col("siblings") == 1).alias("alone"), F.explode("steps.key").alias("key")), "trie-steps"
    )
    # A block that all who reach it share, to its end: its turns have its members. Else turn by turn.
    whole = flat.where("alone").select("key", "k", F.col("c").alias("conv_id"), F.col("n").alias("n_convs"))
    refined = flat.where("not alone").groupBy("key", "k").agg(F.min("c").alias("conv_id"), F.sum("n").alias("n_convs"))
    found = whole.unionByName(refined.select(*whole.columns))
    place = (F.col("key.d") - F.col("k") * BLOCK).cast("int")
    own = blocks.select(F.col("c").alias("conv_id"), "k", "before", "steps")
    return saved(
        found.join(own, ["conv_id", "k"]).select(
            "key", "conv_id", "n_convs", "k",
            F.when(place == 1, F.col("before")).otherwise(F.get("steps", place - 2)["key"]).alias("parent"),
            F.get("steps", place - 1)["size"].alias("size"),
            F.slice("steps.key", F.lit(1), place).alias("path"),
        ),
        "trie-nodes",
    )


def _list_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each node's ids, ascending and joined by commas.

    Ids meet in packs of 1,024 consecutive numbers first; the packs of a node pass one task in order, and
    only the state of the hash is held.
    """
    packs = ends.groupBy("key", F.floor(F.col("c") / PACK).alias("pack")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids")
    )
    keyed = packs.select(F.to_json("key").alias("name"), "pack", "ids")
    ordered = keyed.repartition("name").sortWithinPartitions("name", "pack")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch["name"].to_pylist(), batch["ids"].to_pylist()):
                if key != name:
                    if state is not None:
                        out.append((name, state.hexdigest()))
                    name, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _pairs(out)
        if state is not None:
            yield _pairs([(name, state.hexdigest())])

    return arrow(ordered, run, "name string, ends_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["name", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, the root included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves and
    saved_tokens of the subtree, ends_sha256 of the members that end here. ``conversations`` needs conv_id,
    turn, role and text; other columns are ignored. Null roles and texts are empty ones; a null turn comes
    first; turns of equal number go by the digest of role and text; repeated rows are turns like others.
    Rows without a conv_id belong to no conversation and are left out. An empty table gives no rows.

    Long conversations and those that many share are no special case: turns are numbered by ranges, blocks
    are put in order by slices of 256, members are counted with a map-side half.
    """
    convs, turns = rebuilt(numbered_turns(conversations))
    blocks = _blocks(turns)
    nodes = _nodes(blocks)
    kids = nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    worth = ((F.col("n_convs") - 1) * F.col("size")).alias("v")
    nodes = saved(
        nodes.join(kids.withColumnRenamed("parent", "key"), "key", "left").select(
            *nodes.columns, F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), worth
        ),
        "trie-counted",
    )

    own = nodes.groupBy(F.col("conv_id").alias("c"), "k").agg(
        F.sum("v").alias("v"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    zero = F.lit(0).cast("long")
    paths = running(
        blocks.select("c", "k", "steps", "end").join(own, ["c", "k"], "left"), ["c"], ["k"], F.floor(F.col("k") / SLICE),
        [
            Running("later", "sum", F.coalesce("v", zero)), Running("leaves", "sum", F.coalesce("leaf", zero), through=True),
            Running("following", "sum", F.lit(1).cast("long")),
        ],
        backward=True,
    )
    paths = saved(paths.select("c", "steps", "end", "later", "leaves", "following"), "trie-paths")

    through = paths.groupBy("end").agg(F.sum("later").alias("later"), F.sum("leaves").alias("leaves"), F.min("c").alias("c"))
    # Steps of a group are those of any member; they come by its smallest one.
    through = through.join(paths.select("c", "end", "steps"), ["c", "end"])
    sums = (
        through.select(F.explode("steps.key").alias("key"), "later", "leaves")
        .unionByName(nodes.select(F.explode("path").alias("key"), F.col("v").alias("later"), zero.alias("leaves")))
        .groupBy("key")
        .agg(F.sum("later").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    )

    root_key = _key(F.lit(0), [zero] * len(LANES))
    last = paths.where("following = 0").select("c", F.col("end").alias("key"))
    turnless = convs.join(blocks.where("k = 0").select("c"), "c", "left_anti").select("c", root_key.alias("key"))
    lists = saved(_list_digests(last.unionByName(turnless)), "trie-ends")

    # Four numbers of the whole trie.
    tops = nodes.agg(
        F.sum((F.col("key.d") == 1).cast("long")).alias("n_children"), F.sum("v").alias("saved_tokens"),
        F.sum((F.col("n_children") == 0).cast("long")).alias("n_leaves"),
    ).first()
    whole = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    number = lambda v: F.lit(v).cast("long")
    root = conversations.sparkSession.range(1 if whole["n_convs"] else 0).select(
        root_key.alias("key"), number(whole["conv_id"]).alias("conv_id"), number(None).alias("parent_conv_id"),
        number(whole["n_convs"]).alias("n_convs"), number(tops["n_children"] or 0).alias("n_children"),
        number(tops["n_leaves"] or 1).alias("n_leaves"), number(tops["saved_tokens"] or 0).alias("saved_tokens"),
    )
    named = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    first = nodes.where("key.d = 1").withColumn("parent_conv_id", number(whole["conv_id"]))
    deeper = nodes.where("key.d > 1").join(named, "parent")
    below = first.unionByName(deeper.select(*first.columns)).join(sums, "key")
    rows = below.select(*root.columns).unionByName(root).withColumn("name", F.to_json("key"))
    return rows.join(lists, "name", "left").select(
        "conv_id", F.col("key.d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
