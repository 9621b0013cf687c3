"""Lexical search, the prefix trie and sharding: odd rows, brute force, laws."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import lexical_search, prefix_trie, sharding
from millrace.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, terms string, `a.b` int"
ITEMS = "item_id long, text string, term string, count int"
CONVS = "conv_id long, turn long, role string, text string, k int, `key` string"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def searched(docs, items, most):
    """The ranking by its definition; documents without an id stand behind the others."""
    bags = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for doc, bag, n in bags:
            m = 25 + 75 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in TERM.findall(lowered(text)) if t in bag
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if no else d, -s) for rank, (s, no, d) in enumerate(sorted(scores)[:most], start=1)]
    return sorted(out, key=repr)


def corpus(rng, n):
    words = ["Ä", "ab", "AB", "x1", "straße", "日本", "a-b", "the", " ", "É", "q_r", "1", "zz\tz"]
    text = lambda: rng.choice([" ", ".", "\n", "--"]).join(rng.choices(words, k=rng.randrange(25)))
    return [(rng.choice([None, *range(60)]), rng.choice([None, "", "...", text(), text(), text(), text()])) for _ in range(n)]


def test_search_by_brute_force(spark):
    rng = random.Random(8)
    docs = corpus(rng, 150) + [(900 + n, "the ab straße") for n in range(40)] + [(7, " ".join(["the"] * 300_000 + ["日本"]))]
    items = corpus(rng, 25) + [(None, "ab"), (1, "the the ab"), (1, "the the ab"), (2, "straße 日本"), (3, "nowhere"), (4, None)]
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS).repartition(7)
    right = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    # Equal texts are the same item; a null text counts as an empty one.
    want = searched(docs, [(i, t or "") for i, t in items], 5)
    for block in (lexical_search.POSTINGS, 20):
        got = lexical_search.ranked(left, right, most=5, block=block)
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_search_steps_of_any_size_agree(spark, folder, monkeypatch):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, lexical_search.ranked(docs, items).collect()))
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    monkeypatch.setattr(lexical_search, "MERGED", 1)
    index = lexical_search.index_of(lexical_search._postings(items).toArrow())
    assert len(index.item_ids) == items.count() and index.starts[-1] == len(index.items)
    assert sorted(map(tuple, lexical_search.ranked(docs.repartition(9), items).collect())) == want


def test_term_counts_of_long_texts_are_cut_at_blanks(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choices(["Ab", "ä", "c9", "--", "\x85"], k=4_000)).encode()
    whole = lexical_search.term_counts(text)
    for stretch in (1, 7, 100):
        monkeypatch.setattr(lexical_search, "STRETCH", stretch)
        assert lexical_search.term_counts(text) == whole


def test_search_of_empty_tables(spark):
    none, docs = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a", "x", 1)], DOCS)
    items, nothing = spark.createDataFrame([(1, "a", "x", 1)], ITEMS), spark.createDataFrame([], ITEMS)
    assert lexical_search.ranked(none, items).count() == lexical_search.ranked(docs, nothing).count() == 0
    assert lexical_search.ranked(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.ranked(docs.withColumn("text", F.lit("..")), items).count() == 0


def trie(rows):
    """The trie by its definition, node by node."""
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            by.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v)] for c, v in by.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        ends = ",".join(str(c) for c in sorted(members) if built[c] == path)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], CONVS)


def test_trie_by_brute_force(spark):
    rng = random.Random(5)
    say = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["hi", "ho", "né", "", None]))
    rows = [(c, t, *say()) for c in range(-6, 60) for t in range(rng.randrange(14))]
    # Copies, repeated and missing turn numbers, repeated rows, a conversation of many turns, rows without an id.
    rows += [(c, t, "user", "same") for c in range(100, 180) for t in range(6)]
    rows += [(200, None, "user", "x"), (200, None, "user", "a"), (200, 1, "user", "b"), (200, 1, "user", "b"), (201, 5, "a", "b")]
    rows += [(300, t, "user", f"t{t % 7}") for t in range(120)] + [(305, t, "user", f"t{t % 7}") for t in range(119)]
    rows += [(None, 1, "user", "lost"), (10**12, 0, None, None)]
    got = prefix_trie.prefix_trie(conversations(spark, rows).repartition(5))
    assert sorted(map(tuple, got.collect()), key=repr) == trie(rows)


def test_long_conversations_are_cut(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    monkeypatch.setattr(prefix_trie, "PACK", 3)
    rng = random.Random(6)
    rows = [(c, t, "u", rng.choice("ab")) for c in range(40) for t in range(rng.randrange(40))]
    rows += [(c, t, "u", "x") for c in range(500, 540) for t in range(11)]
    assert sorted(map(tuple, prefix_trie.prefix_trie(conversations(spark, rows)).collect()), key=repr) == trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.prefix_trie(conversations(spark, [])).count() == 0
    # A conversation whose only turn is replaced by those of an absent one has none.
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(lone, 0, "user", "x")]
    assert sorted(map(tuple, prefix_trie.prefix_trie(conversations(spark, rows)).collect())) == trie(rows)


def test_draws_follow_the_hypergeometric_distribution(spark):
    big = lambda v: F.lit(v).cast("bigint")
    n = 20_000
    for total, good, draws in ((10, 4, 3), (60, 25, 30), (3_000, 400, 300), (100_000, 12_500, 900)):
        drawn = spark.range(0, n, 1, 8).select(sharding.hypergeometric(big(total), big(good), big(draws), F.lit(3), F.col("id")).alias("x"))
        seen = {r.x: r["count"] for r in drawn.groupBy("x").count().collect()}
        ways = {z: math.comb(good, z) * math.comb(total - good, draws - z) / math.comb(total, draws) for z in range(max(0, draws - total + good), min(good, draws) + 1)}
        assert set(seen) <= set(ways)
        usual = {z: n * p for z, p in ways.items() if n * p >= 5}
        chi = sum((seen.get(z, 0) - e) ** 2 / e for z, e in usual.items())
        free = len(usual) - 1
        assert chi < free + 5 * math.sqrt(2 * free) + 5
    edge = lambda *a: spark.range(1).select(sharding.hypergeometric(*map(big, a), F.lit(1))).first()[0]
    assert [edge(5, 5, 3), edge(5, 0, 3), edge(5, 2, 0), edge(5, 2, 5), edge(0, 0, 0)] == [3, 0, 0, 2, 0]
    # Far beyond what factorials can be summed for: near its mean, within six deviations.
    assert abs(edge(30_000_000_000, 3_750_000_000, 100_000_000) - 12_500_000) < 6 * math.sqrt(1e8 / 8 * 7 / 8)


def test_matrix_has_its_sums_at_any_number_of_parts(spark):
    for parts in (1, 5, 64, 65, 200):
        sizes = [(p * 37) % 11 * 9 for p in range(parts)]
        counts = spark.createDataFrame([(p * 3, n) for p, n in enumerate(sizes)], "part long, n long")
        wanted = sharding.even_sizes(sum(sizes), 5)
        rows = {r.part: r.cells for r in sharding.communication_matrix(counts, wanted, 1).collect()}
        assert {p * 3: n for p, n in enumerate(sizes)} == {p: sum(c) for p, c in rows.items()}
        assert [sum(c[j] for c in rows.values()) for j in range(5)] == wanted
        assert all(v >= 0 for c in rows.values() for v in c)


def held(df):
    rows = [(r.shard, r.slot) for r in df.select("shard", "slot").collect()]
    by = {s: sorted(b for a, b in rows if a == s) for s, _ in rows}
    assert all(v == list(range(len(v))) for v in by.values())
    return {s: len(v) for s, v in by.items()}


def test_shards_have_exact_sizes_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 10)
    rows = [(n if n % 3 else None, "x" * (n % 5 * 9000) if n % 4 else "same", "s", 1, n) for n in range(501)]
    kind = "doc_id long, text string, shard string, `a.b` int, place int"
    df = spark.createDataFrame(rows, kind)
    for parts in (1, 3, 70):
        out = sharding.sharded(df.repartition(parts), 8)
        assert held(out) == {s: 501 // 8 + (s < 501 % 8) for s in range(8)}
        assert sorted(r[0] for r in out.select("place").collect()) == list(range(501))
        assert out.columns == ["doc_id", "text", "a.b", "place", "shard", "slot"]
        back = {r.place: (r.doc_id, r.text, r["a.b"]) for r in out.collect()}
        assert back == {r[4]: (r[0], r[1], 1) for r in rows}
    assert sharding.sharded(df.where("place < 0"), 8).count() == 0
    assert held(sharding.sharded(df.limit(3), 8)) == {0: 1, 1: 1, 2: 1}


def test_all_orders_are_equally_likely(spark):
    """Each row over many seeds: every shard and every end of a shard about equally often."""
    df = spark.range(24).repartition(5).select(F.col("id").alias("doc_id"))
    seen = Counter()
    runs = 10
    for seed in range(runs):
        for r in sharding.sharded(df, 4, seed).collect():
            seen[("shard", r.doc_id, r.shard)] += 1
            seen[("slot", r.slot, r.doc_id % 2)] += 1
    chi = sum((seen[("shard", d, s)] - runs / 4) ** 2 / (runs / 4) for d in range(24) for s in range(4))
    assert chi < 72 + 5 * math.sqrt(144)
    chi = sum((seen[("slot", s, h)] - runs * 2) ** 2 / (runs * 2) for s in range(6) for h in range(2))
    assert chi < 12 + 5 * math.sqrt(24)


def test_sharding_query(spark, folder):
    out = QUERIES["op13_sharding"](spark, folder)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes = held(out)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1
    for r in out.collect():
        text = (texts.pop(r.doc_id) or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
    assert not texts


def test_shingles_that_others_have_bound_what_is_common(spark):
    """Against sets by hand; the bound holds for all pairs and is reached by equal sets."""
    from millrace.llm import fast_minhash

    rng = random.Random(12)
    base = [f"w{n}" for n in range(60)]
    texts = []
    for _ in range(25):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(60)] = f"x{rng.randrange(400)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.common for r in fast_minhash._shareable(docs, docs.select(F.col("doc_id").alias("id"))).collect()}
    sets = [set(fast_minhash.shingle_set(t.encode()).tolist()) for t in texts]
    assert got == {n: len(s & set().union(*(o for k, o in enumerate(sets) if k != n))) for n, s in enumerate(sets)}
    assert all(len(a & b) <= min(got[n], got[k]) for n, a in enumerate(sets) for k, b in enumerate(sets) if n != k)


def test_added_links_rename_only_what_they_join(spark):
    from millrace.llm import fast_minhash

    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "id long, component_id long")
    added = spark.createDataFrame([(6, 2), (3, 9), (3, 4), (1, 2)], "a long, b long")
    got = {r.id: r.component_id for r in fast_minhash._contracted(labels, added).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 8: 3, 9: 3, 3: 3, 4: 3}
