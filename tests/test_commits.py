"""A sink with commits, bloom filters, and the list of hot queries as a changelog."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import blooms, dedup, search
from millrace.sources import committed as sink
from millrace.sources.keyed import BucketedTable
from millrace.streaming import jobs

KEPT = lambda root: sorted(d for d in os.listdir(root) if d != sink.STAGING)


def test_a_failed_job_leaves_nothing_and_a_retried_one_writes_once(spark, tmp_path):
    root = str(tmp_path / "lines")
    rows = spark.range(0, 1_000, 1, 4).withColumn("name", F.concat(F.lit("n"), "id"))
    broken = rows.withColumn("name", F.when(F.col("id") == 990, F.raise_error(F.lit("torn"))).otherwise(F.col("name")))
    with pytest.raises(PySparkException):
        sink.write_committed(broken, root, "job-1")
    assert not sink.committed(spark, root, "job-1")
    left = [f for at, _, names in os.walk(root) for f in names]
    assert left == []
    for _ in range(2):
        sink.write_committed(rows, root, "job-1", file_lines=100)
    read = sink.read_committed(spark, root, "id bigint, name string")
    assert read.count() == 1_000 and read.distinct().count() == 1_000
    assert KEPT(root) == ["job-1"] and len([f for f in os.listdir(f"{root}/job-1") if f.endswith(".json")]) >= 10
    sink.write_committed(spark.createDataFrame([], rows.schema), root, "job-2")
    sink.write_committed(rows.limit(3), root, "job-3")
    assert sink.read_committed(spark, root, "id bigint, name string").count() == 1_003
    assert KEPT(root) == ["job-1", "job-2", "job-3"]


def test_files_of_lost_attempts_are_not_committed(tmp_path):
    writer = sink.LinesWriter(str(tmp_path), "job", 10)
    lost = writer.write(iter([("lost",)]))
    kept = writer.write(iter([(f"line {n}",) for n in range(25)]))
    assert (lost.lines, kept.lines, len(kept.files)) == (1, 25, 3)
    writer.commit([kept, None])
    assert sorted(os.listdir(tmp_path / "job")) == sorted(kept.files)
    again = sink.LinesWriter(str(tmp_path), "job", 10)
    again.commit([again.write(iter([("twice",)]))])
    assert sorted(os.listdir(tmp_path / "job")) == sorted(kept.files)
    gone = sink.LinesWriter(str(tmp_path), "other", 10)
    gone.write(iter([("x",)]))
    gone.abort([None])
    assert not os.path.exists(tmp_path / "other") and os.listdir(tmp_path / sink.STAGING) == []


def test_micro_batches_commit_once(spark, tmp_path):
    root = str(tmp_path / "batches")
    write = sink.committed_batches(root)
    for batch_id in (0, 0, 1):
        write(spark.range(5), batch_id)
    assert sink.read_committed(spark, root, "id bigint").count() == 10


def test_bloom_filter_keeps_its_rate_and_misses_nothing(spark):
    known = spark.range(20_000).select((F.col("id") * 7).alias("id"))
    for rate in (0.2, 0.01, 0.0005):
        halves = [blooms.build(known.where(F.col("id") % 2 == h), ["id"], 20_000, rate) for h in (0, 1)]
        built = blooms.merged(*halves)
        asked = blooms.probed(spark.range(140_000), built, ["id"], 20_000, rate)
        counts = {(r.there, r.maybe): r["count"] for r in asked.groupBy((F.col("id") % 7 == 0).alias("there"), "maybe").count().collect()}
        assert (True, False) not in counts
        wrong = counts.get((False, True), 0) / 120_000
        assert wrong <= 1.5 * rate and (rate < 0.01 or wrong >= 0.3 * rate)


def test_new_pairs_equal_the_exact_answer(spark, same):
    rng = random.Random(3)
    pair = lambda n: [(rng.choice([None, *range(30)]), f"v{rng.randrange(40)}", i) for i in range(n)]
    kind = "a int, b string, seq int"
    known, rows = spark.createDataFrame(pair(400), kind), spark.createDataFrame(pair(600), kind)
    fresh, figures = blooms.new_pairs(rows, known, "a", "b", ["seq"])
    seen = {(r.a, r.b) for r in known.collect()}
    want = {}
    for r in sorted(rows.collect(), key=lambda r: r.seq):
        if (r.a, r.b) not in seen:
            want.setdefault((r.a, r.b), tuple(r))
    assert sorted(map(repr, want.values())) == sorted(repr(tuple(r)) for r in fresh.collect())
    asked, measured = figures.first()
    assert asked == 0.01 and measured <= 0.05
    none = spark.createDataFrame([], kind)
    same(blooms.new_pairs(rows, none, "a", "b", ["seq"])[0], dedup.dedup_pair(rows, "a", "b", ["seq"]))
    assert blooms.new_pairs(none, known, "a", "b", ["seq"])[0].isEmpty()


@pytest.mark.parametrize("stretch", [1, 7, 50, 10**6])
def test_hot_query_changes_by_brute_force(spark, stretch):
    rng = random.Random(stretch)
    counts = {}
    for _ in range(400):
        counts[(f"q{min(rng.randrange(25), rng.randrange(25))}", rng.randrange(0, 200, 3))] = rng.randrange(1, 5)
    df = spark.createDataFrame([(q, n, w) for (q, w), n in counts.items()], "query string, query_count bigint, window_end bigint")
    want, totals, listed = [], {}, {}
    for w in sorted({w for _, w in counts}):
        for (q, at), n in counts.items():
            if at == w:
                totals[q] = totals.get(q, 0) + n
        now = {q: (r, n) for r, (q, n) in enumerate(sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:4], start=1)}
        for q in now.keys() | listed.keys():
            rank, before = now.get(q, (0, 0))[0], listed.get(q, (0, 0))[0]
            if rank != before:
                kind = "entered" if not before else "moved" if rank else "left"
                want.append((w, q, kind, rank, before, (now.get(q) or listed[q])[1]))
        listed = now
    assert sorted(want) == sorted(map(tuple, search.hot_query_changes(df, 4, stretch).collect()))


def test_bucketed_table_rewrites_what_a_batch_touches(spark, tmp_path):
    root = str(tmp_path / "keyed")
    table = BucketedTable(root, ("k",), ("ts",), buckets=8)
    rng = random.Random(4)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    want, versions = {}, {}
    for batch in range(5):
        rows = [(rng.randrange(60), rng.randrange(20), f"b{batch}-{n}") for n in range(30 if batch else 200)]
        rows = list({(k, ts): (k, ts, v) for k, ts, v in rows}.values())
        for k, ts, v in sorted(rows):
            if k not in want or ts >= want[k][0]:
                want[k] = (ts, v)
        frame = spark.createDataFrame(rows, "k int, ts int, v string")
        for _ in range(2):
            table.write_batch(frame, batch)
        assert {r.k: (r.ts, r.v) for r in table.read(spark).collect()} == want
        state = table._newest()
        touched = {str(r[0]) for r in frame.select(table._bucket()).collect()}
        assert all(versions.get(b) == v for b, v in state["versions"].items() if b not in touched)
        versions = state["versions"]
    table.write_batch(spark.createDataFrame([(1, 99, "last")], "k int, ts int, v string"), 5)
    assert sum(a != b for a, b in zip(versions.values(), table._newest()["versions"].values())) == 1
    left = {(d.split("/")[-2], d.split("/")[-1]) for d, _, names in os.walk(root) if any(f.endswith(".parquet") for f in names)}
    named = {(v, f"__bucket={b}") for p in table._manifests() for b, v in table._manifest(p)["versions"].items()}
    assert left == named and len(table._manifests()) == 2


def test_streams_upsert_into_buckets(spark, feed, tmp_path, same):
    rows = spark.createDataFrame([(n % 7, n, f"v{n}") for n in range(60)], "k int, ts int, v string")
    table = BucketedTable(str(tmp_path / "stream"), ("k",), ("ts",), buckets=4)
    jobs.run_available(feed(rows, ["ts"]), "buckets", jobs.upsert_into(table), location=str(tmp_path / "cp"))
    same(table.read(spark), rows.where("ts >= 53"))
