"""Near-duplicate texts by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import connected_components
from millrace.llm.tables import arrow, saved, whole_row
from millrace.operators.joins import broadcast_if_small

WORDS_PER_SHINGLE = 5
PERCENT = 75
COORDINATES = 1024
BANDS = 32
ROWS = 4
# Two sets at the threshold agree in 7/8 of their sketches' single bits on average (a coordinate that
# differs still agrees by chance), with a deviation of 1.03 % for independent draws. 836 of 1024 is 5.7 deviations
# below: 3e-8 of such pairs have less (binomial tail), far fewer than share no band.
LEAST_BITS = 836

U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A strong one-to-one mixing of 64-bit numbers (xor-shift and multiply)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_set(text: bytes | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text (UTF-8); empty without words.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at the bytes 20 and 09-0D only, as asked.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, U64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    width = min(WORDS_PER_SHINGLE, len(h))
    s = np.full(len(h) - width + 1, width, U64)
    for k in range(width):
        s = (s ^ h[k : len(h) - width + 1 + k]) * U64(0x9E3779B97F4A7C15)
        s ^= s >> U64(32)
    s = np.sort(_mix(s))
    return s[np.append(True, s[1:] != s[:-1])]


SEEDS = _mix(np.arange(1, 2 * COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
UNSET = U64(np.iinfo(np.uint64).max)
# Members to place until every bin is likely reached: bins * ln(bins), and a little more.
PLACED = int(1.2 * COORDINATES * np.log(COORDINATES))


def sketch(members: np.ndarray) -> np.ndarray:
    """One value per coordinate, by rounds of hashed bin placement.

    In round i every member falls into a hashed bin with a hashed value. A bin keeps the smallest value of
    the first round that reached it; rounds are placed several at a time, as the round leads the value.
    After as many rounds as there are bins, one round each is dealt to one bin alone, so none stays empty.
    The cost is that of the set plus bins * log(bins), not of set times coordinates. Two sets agree in a
    coordinate with the probability of their similarity, concentrated as for independent draws.
    """
    out = np.full(COORDINATES, UNSET, U64)
    at_once = max(1, -(-PLACED // len(members)))
    for start in range(0, COORDINATES, at_once):
        rounds = np.arange(start, min(start + at_once, COORDINATES), dtype=U64)
        h = _mix(members ^ SEEDS[start : start + len(rounds), None])
        np.minimum.at(out, (h & U64(COORDINATES - 1)).ravel().astype(np.intp), ((h >> U64(11)) | (rounds[:, None] << U64(53))).ravel())
        empty = np.flatnonzero(out == UNSET)
        if not len(empty):
            return out
    for k in empty:
        out[k] = _mix(members ^ SEEDS[COORDINATES + k]).min()
    return out


BAND_SEEDS = _mix(np.arange(1001, 1001 + BANDS, dtype=U64))
BIT_SEEDS = _mix(np.arange(5001, 5001 + COORDINATES, dtype=U64))


def _bands(values: np.ndarray) -> np.ndarray:
    key = BAND_SEEDS.copy()
    for part in values[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        key = _mix(key ^ part) * U64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def _bits(values: np.ndarray) -> np.ndarray:
    bits = (_mix(values ^ BIT_SEEDS) >> U64(63)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


SKETCHES = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
        ("bits", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())),
    ]
)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            members = shingle_set(text.as_py())
            if not len(members):
                rows.append((doc, 0, None, None, None, None))
                continue
            digest = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), np.int64)
            values = sketch(members)
            rows.append((doc, len(members), int(digest[0]), int(digest[1]), _bits(values), _bands(values)))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, SKETCHES, strict=True)], schema=SKETCHES
        )


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, single bits of the sketch, band keys) per document."""
    return arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")),
        _sketch_batches,
        "doc_id long, n_shingles long, d1 long, d2 long, bits array<long>, keys array<long>",
    )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both whole texts; keeps those whose sets are similar enough."""
    last: tuple[int | None, np.ndarray] = (None, np.empty(0, U64))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        found = []
        for a, b, left, right in zip(
            batch["a"].to_pylist(), batch["b"].to_pylist(), batch["left"], batch["right"], strict=True
        ):
            if last[0] != a:
                last = (a, shingle_set(left.as_py()))
            other = shingle_set(right.as_py())
            common = len(np.intersect1d(last[1], other, assume_unique=True))
            if 100 * common >= PERCENT * (len(last[1]) + len(other) - common):
                found.append((a, b))
        ends = list(zip(*found, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ends], schema=schema)


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole texts pass. One row per pair meets the texts of its two ends in turn."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).dropDuplicates(["doc_id"])
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return arrow(both, _confirm, "a long, b long")


def _sizes(x: str, y: str) -> Column:
    """The sets' sizes alone don't rule the pair out."""
    return (100 * F.least(x, y)) >= PERCENT * F.greatest(x, y)


def _bits_alike(x: str, y: str) -> Column:
    """The sketches' single bits don't rule the pair out."""
    differing = sum(F.bit_count(F.get(x, i).bitwiseXOR(F.get(y, i))) for i in range(COORDINATES // 64))
    return differing <= COORDINATES - LEAST_BITS


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
            found = shingle_set(text.as_py()).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), doc)), pa.array(found)], names=["id", "shingle"])


def _shareable(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, common): how many shingles of each of these documents are in another one of them, too.

    No two of them have more than the smaller of their numbers in common.
    """
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    wanted = texts.join(broadcast_if_small(ids), "id").dropDuplicates(["id"])
    shingles = arrow(wanted, _shingle_rows, "id long, shingle long")
    owners = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("id").alias("id"))
    single = owners.where("sets = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    sizes = shingles.groupBy("id").agg(F.count(F.lit(1)).alias("all"))
    return sizes.join(single, "id", "left").select("id", (F.col("all") - F.coalesce("own", F.lit(0))).alias("common"))


def _contracted(labels: DataFrame, added: DataFrame) -> DataFrame:
    """The labels after more links: only the components that these join are named anew."""
    name = lambda end: labels.select(F.col("id").alias(end), F.col("component_id").alias(f"{end}_component"))
    ends = added.join(name("a"), "a", "left").join(name("b"), "b", "left")
    joined = ends.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    renamed = connected_components(joined).select(F.col("id").alias("component_id"), F.col("component_id").alias("now"))
    alone = added.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(labels, "id", "left_anti")
    known = labels.unionByName(alone.select("id", F.col("id").alias("component_id")))
    return saved(known.join(renamed, "component_id", "left").select("id", F.coalesce("now", "component_id").alias("component_id")), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept (the smallest id of its component).

    ``docs`` needs doc_id (long, one document per id) and text; other columns are ignored. Documents
    whose sets of 5-word shingles have 100 * intersection >= 75 * union are linked:

    1. Texts with equal sets form a class, named by its smallest id; only that one goes on.
    2. Classes that share a band of four sketch coordinates meet. A pair at the threshold shares none of
       the 32 bands with a probability of 5e-6, at 0.8 of 5e-8. In each bucket all members meet the
       most central one, whose buckets are the largest: the least changed copy of a group is in most of them.
       Sizes and 1,024 sketch bits rule out most false pairs, whole texts confirm the rest.
    3. Buckets that are not yet one component: every member outside the most frequent component is held
       against every member of another component, by sizes, by sketch bits and by how many of its shingles
       any other member of such buckets has, within the join; whole texts confirm the pairs that are left. The
       shingles that only one set has bound what it can have in common with others, so members that are changed
       too much to link drop out before they meet. Then no pair of a bucket is left that could join two
       components, and a group of n near copies costs about n confirmed pairs, not n * n.

    Nothing is capped or sampled. A null or empty text, or one without words, has an empty set and is its
    own component. Equal rows give equal results; a row with a null id links with nothing and is kept. An
    empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    signs = saved(sketches(docs), "sketches")
    classes = signs.where("d1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    members = signs.join(classes, ["d1", "d2"])
    named = members.where("doc_id = rep").dropDuplicates(["doc_id"])
    buckets = named.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
    crowded = buckets.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = saved(buckets.join(crowded, "key"), "buckets")
    central = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    hubs = (
        shared.join(central, "id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"), "n")).alias("top"))
        .select("key", (-F.col("top.id")).alias("hub"), F.col("top.n").alias("hub_n"))
    )
    met = saved(shared.join(hubs, "key"), "met")
    bits = signs.where("d1 IS NOT NULL").select(F.col("doc_id").alias("id"), "bits").dropDuplicates(["id"])
    star = met.where("id <> hub").where(_sizes("n", "hub_n")).select(F.col("hub").alias("a"), F.col("id").alias("b"))
    pairs = saved(
        star.distinct()
        .join(bits.select(F.col("id").alias("a"), F.col("bits").alias("bits_a")), "a")
        .join(bits.select(F.col("id").alias("b"), F.col("bits").alias("bits_b")), "b")
        .where(_bits_alike("bits_a", "bits_b"))
        .select("a", "b"),
        "pairs",
    )
    links = saved(confirmed(pairs, docs), "links")
    labels = connected_components(links)

    inside = saved(
        met.where("size > 2").select("key", "id", "n")
        .join(labels, "id", "left")
        .select("key", "id", "n", F.coalesce("component_id", "id").alias("component")),
        "inside",
    )
    mixed = inside.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    if not mixed.isEmpty():
        counts = inside.groupBy("key", "component").count()
        main = counts.join(mixed, "key").groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
        left = saved(inside.join(main, "key"), "left")
        shareable = _shareable(docs, left.select("id").distinct())
        sketched = signs.where("d1 IS NOT NULL").select(F.col("doc_id").alias("id"), "bits", "keys").dropDuplicates(["id"])
        # A link takes three quarters of either set, so a set with less to share has none here.
        held = saved(left.join(shareable, "id").where("4 * common >= 3 * n").join(sketched, "id"), "held")
        sides = ("id", "n", "common", "component", "bits", "keys")
        x = held.where("component <> main").select("key", *[F.col(c).alias(f"{c}_x") for c in sides])
        y = held.select("key", *[F.col(c).alias(f"{c}_y") for c in sides])
        # A pair that shares several buckets is taken up in the first of them alone.
        first = F.col("key") == F.array_min(F.array_intersect("keys_x", "keys_y"))
        # 100 * c >= 75 * (n_x + n_y - c) for the common part c, which is within what either shares with anyone.
        enough = 7 * F.least("common_x", "common_y") >= 3 * (F.col("n_x") + F.col("n_y"))
        more = (
            x.join(y, "key")
            .where("component_x <> component_y")
            .where(enough & _sizes("n_x", "n_y") & _bits_alike("bits_x", "bits_y") & first)
            .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))
            .distinct()
            .join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        )
        added = saved(confirmed(saved(more, "pairs"), docs), "links")
        if not added.isEmpty():
            labels = _contracted(labels, added)

    found = members.select("doc_id", "rep").distinct().join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id", F.coalesce("component_id", "rep").alias("found")
    )
    out = signs.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("found", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, with its columns; rows without an id all stay."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(whole_row(docs).alias("document"), F.col("doc_id").alias("own_id"))
    found = rows.join(kept, F.col("own_id") == F.col("kept_id"), "left_semi").dropDuplicates(["own_id"])
    return found.select("document.*").union(docs.where("doc_id IS NULL"))
