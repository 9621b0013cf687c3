"""Hot keys: the split forms give what the plain forms give, and the plans are the wanted ones."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from millrace.functions import times
from millrace.operators import customers, dedup, joins, moderation, running as run_module, trade, traffic
from millrace.operators.running import Running, running
from millrace.plans.views import Inputs

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """1,200 rows, half of them of one key, many at equal times."""
    rng = random.Random(7)
    rows = [
        (
            "hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}",
            START + timedelta(minutes=rng.randrange(600)),
            n,
            rng.randrange(100),
        )
        for n in range(1200)
    ]
    return spark.createDataFrame(rows, "k string, ts timestamp, seq bigint, v bigint").cache()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [60, 3600, 10**9])
@pytest.mark.parametrize("backward", [False, True])
def test_running_equals_plain_window(hot, same, width, backward):
    order = [F.desc("ts"), F.desc("seq")] if backward else ["ts", "seq"]
    before = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = hot.select(
        "*",
        F.coalesce(F.sum("v").over(before), F.lit(0)).alias("s0"),
        F.max("v").over(before).alias("m0"),
        F.sum("v").over(through).alias("s1"),
        F.max("v").over(through).alias("m1"),
    )
    measured = running(
        hot,
        ["k"],
        ["ts", "seq"],
        times.seconds_slice(F.col("ts"), width),
        [
            Running("s0", "sum", F.col("v")),
            Running("m0", "max", F.col("v")),
            Running("s1", "sum", F.col("v"), through=True),
            Running("m1", "max", F.col("v"), through=True),
        ],
        backward,
    )
    same(measured, expected)


def test_no_window_over_a_whole_hot_key(hot):
    """Windows over raw rows are partitioned by key and slice, never by the key alone."""
    details = hot.select(F.col("k").alias("id"), "ts", "seq", "v")
    text = plan(dedup.retract_dedup(details, "id", ["ts", "seq", "v"], ["v"], times.seconds_slice(F.col("ts"), 3600)))
    over_rows = [line for line in text.splitlines() if "Window [" in line and "seq" in line]
    assert over_rows and all("__slice" in line for line in over_rows)


def test_first_and_last_per_key_combine_before_the_shuffle(hot):
    for df in (
        run_module.first_per_key(hot, ["k"], ["ts", "seq"], ["v"]),
        run_module.latest_per_key(hot, ["k"], ["ts", "seq"]),
    ):
        text = plan(df)
        assert "partial_m" in text and "Window" not in text


def test_retract_with_equal_rows(spark):
    same_row = ("a", START, 5)
    df = spark.createDataFrame([same_row, same_row, same_row, ("b", START, 1)], "id string, ts timestamp, v bigint")
    out = dedup.retract_dedup(df, "id", ["ts", "v"], ["v"], F.lit(0)).groupBy("id").agg(
        F.sum("v").alias("v"), F.count("*").alias("n")
    )
    assert {tuple(r) for r in out.collect()} == {("a", 5, 5), ("b", 1, 1)}


@pytest.mark.parametrize("lower,upper", [(-300, 300), (0, 60), (-1800, 5), (30, 30)])
def test_interval_join_equals_brute_force(hot, same, lower, upper):
    left = hot.where(F.col("seq") < 300).select("k", F.col("ts").alias("lt"), F.col("seq").alias("ls"))
    right = hot.where(F.col("seq") >= 900).select("k", F.col("ts").alias("rt"), F.col("seq").alias("rs"))
    fast = joins.interval_join(left, right, ["k"], "lt", "rt", lower, upper)
    ls, rs = left.collect(), right.collect()
    expected = sorted(
        (a.ls, b.rs)
        for a in ls
        for b in rs
        if a.k == b.k and lower <= (b.rt - a.lt).total_seconds() <= upper
    )
    assert sorted((r.ls, r.rs) for r in fast.collect()) == expected


def test_lookup_beyond_the_broadcast_bound(hot, same):
    """A table over the bound is joined by shuffle and gives the same rows."""
    dim = hot.groupBy("k").agg(F.max("v").alias("top"))
    small = joins.broadcast_if_small(dim)
    large = joins.broadcast_if_small(dim, max_rows=3)
    wide = joins.broadcast_if_small(dim, max_bytes=10)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    for other in (large, wide):
        assert "broadcast" not in other._jdf.queryExecution().logical().toString().lower()
        same(
            joins.enrich(hot, other, {"k": "k"}, {"top": "top"}),
            joins.enrich(hot, small, {"k": "k"}, {"top": "top"}),
        )


def test_dictionary_scan_equals_brute_force(spark):
    rng = random.Random(3)
    letters = "abcé,. "
    texts = [(n, "".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 40, 400])))) for n in range(60)]
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.choice([2, 3, 5]))) for _ in range(40)})
    comments = spark.createDataFrame(texts, "id bigint, msg string")
    table = moderation.word_table(spark.createDataFrame([(w.upper(),) for w in words], "word string"))
    found = {r.id: r.hits for r in moderation.dictionary_hits(comments, table, "id").collect()}
    expected = {n: ",".join(w for w in words if w in t) for n, t in texts if any(w in t for w in words)}
    assert found == expected


def test_dictionary_scan_with_very_short_and_long_words(spark):
    """A one-letter word doesn't make every position meet the long ones: one row per position and class."""
    rng = random.Random(5)
    long = "".join(rng.choice("abcde") for _ in range(500))
    texts = [(n, "".join(rng.choice("abcde ") for _ in range(300)) + (long if n % 3 == 0 else "")) for n in range(12)]
    words = ["q", long, *{"".join(rng.choice("abcde") for _ in range(k)) for k in range(5, 60)}]
    comments = spark.createDataFrame(texts, "id bigint, msg string")
    table = moderation.word_table(spark.createDataFrame([(w,) for w in words], "word string"))
    hits = moderation.dictionary_hits(comments, table, "id")
    found = {r.id: r.hits for r in hits.collect()}
    assert found == {n: ",".join(sorted(w for w in words if w in t)) for n, t in texts if any(w in t for w in words)}


def test_empty_dictionary(spark):
    comments = spark.createDataFrame([(1, "text")], "id bigint, msg string")
    table = moderation.word_table(spark.createDataFrame([], "word string"))
    graded = moderation.comment_moderation(comments, table, "id").collect()
    assert [(r.is_violation, r.violation_grade) for r in graded] == [(0, "")]


def test_counts_spread_a_hot_shop_over_users(inputs):
    cleaned = customers.clean(inputs.shop_actions())
    text = plan(customers.shop_customer_day(cleaned))
    assert "hashpartitioning(shop_id" in text and "user_id" in text.split("hashpartitioning(shop_id")[-1][:80]


def test_pruned_scans(inputs):
    text = plan(trade.sku_order_window(inputs.order_detail(), Inputs.DETAIL_ORDER))
    assert "l_returnflag" not in text and "l_linestatus" not in text
    text = plan(inputs.payments())
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    text = plan(traffic.keyword_tokens(inputs.table("documents"), "text", ["lang"]))
    assert "ReadSchema: struct<text:string,lang:string>" in text


def test_window_totals_equal_the_retracted_rows(inputs, same):
    details, order = inputs.order_detail(), Inputs.DETAIL_ORDER
    signed = dedup.retract_dedup(details, "id", order, list(trade.SKU_AMOUNTS), times.seconds_slice(F.col("ts"), 86400))
    expected = signed.groupBy(F.window("ts", "5 seconds"), "sku_id").agg(
        *[F.sum(c).cast("decimal(16,2)").alias(n) for c, n in trade.SKU_AMOUNTS.items()]
    )
    got = trade.sku_order_window(details, order)
    same(got, expected.select(*times.window_bounds(F.col("window")), "sku_id", *trade.SKU_AMOUNTS.values()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_lookup_equals_plain_join(spark, hot, same, how):
    """Copies, unknown keys and null keys keep their rows."""
    odd = spark.createDataFrame([(None, START, 5000, 1), ("none", START, 5001, 2)], hot.schema)
    facts_ = hot.unionByName(hot.where("seq < 200")).unionByName(odd)
    dim = hot.groupBy(F.col("k").alias("id")).agg(F.max("v").alias("top"))
    fast = joins.spread_lookup(facts_, dim, {"k": "id"}, {"top": "top"}, how)
    same(fast, joins.enrich(facts_, dim, {"k": "id"}, {"top": "top"}, how))


def test_rows_without_a_key_lie_in_many_partitions(spark, same):
    """Two thirds of the rows have no key; with broadcasts off they are dealt over all partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("seq"))
        dim = rows.where("k IS NOT NULL").select(F.col("k").alias("id"), F.col("seq").alias("top"))
        joined = joins.spread_lookup(rows, dim, {"k": "id"}, {"top": "top"})
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 1.5 * 30_000 / 16
        same(joined, joins.enrich(rows, dim, {"k": "id"}, {"top": "top"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_all_columns_are_measured_before_a_broadcast(spark):
    nested = spark.range(10).select(F.struct(F.repeat(F.lit("x"), 1000).alias("name")).alias("info"), F.array(F.lit(1)).alias("a"))
    marked = joins.broadcast_if_small(nested, max_bytes=5_000)
    assert "broadcast" not in marked._jdf.queryExecution().logical().toString().lower()


def test_wide_details_read_each_table_once(inputs):
    """No counting pass: details, activities, coupons and orders are scanned once each."""
    from millrace.plans.batch import _wide

    wide = _wide(inputs)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("lineitem.parquet") <= 3


def test_newest_only_with_repeats(spark, same):
    df = spark.createDataFrame(
        [("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 6, 4), ("a", 6, 5), ("b", 1, 6)], "k string, v bigint, seq bigint"
    )
    expected = spark.createDataFrame([("a", 5, 1), ("a", 6, 4), ("b", 1, 6)], df.schema)
    for width in (1, 3, 100):
        same(dedup.newest_only(df, "k", "v", ["seq"], F.floor(F.col("seq") / width).cast("bigint")), expected)


def test_latest_row_with_maps(spark):
    df = spark.createDataFrame([(1, 1, {"a": "x"}), (1, 2, {"a": "y"})], "k int, v int, m map<string,string>")
    assert run_module.latest_per_key(df, ["k"], ["v"]).collect()[0].m == {"a": "y"}


def test_measured_lookups_take_both_ways(hot, same, monkeypatch):
    dim = hot.groupBy(F.col("k").alias("id")).agg(F.max("v").alias("top"))
    tops = hot.groupBy("v").agg(F.min("seq").alias("first")).withColumnRenamed("v", "id")
    lookups = [(dim, {"k": "id"}, {"top": "top"}), (tops, {"top": "id"}, {"first": "first"})]
    small = joins.measured_lookups(hot, lookups)
    monkeypatch.setattr(joins, "broadcast_each_if_small", lambda dims: dims)
    same(joins.measured_lookups(hot, lookups), small)
