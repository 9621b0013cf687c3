"""How often a query's rows are moved: exchanges and reads in the plan as it is before anything runs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import changelog, facts, trade
from millrace.plans.batch import QUERIES
from millrace.plans.views import Inputs


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    """Shuffles in the plan, reused ones left out."""
    return sum("Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line for line in plan(df).splitlines())


@pytest.mark.parametrize("name", ["wide_changelog", "wide_changelog_expiring"])
def test_each_side_of_the_changelog_is_read_once(spark, folder, name):
    """Details, activities and coupons are one read of lineitem each; no join computes its left side again."""
    df = QUERIES[name](spark, folder)
    assert plan(df).count("lineitem.parquet") <= 3
    assert exchanges(df) <= 7


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["wide_changelog", "wide_changelog_expiring"])
def test_each_side_of_the_changelog_is_dealt_once(spark, folder, no_broadcast, name):
    """Orders' two tables, then a side each, and the wide rows once for activities and coupons together."""
    assert exchanges(QUERIES[name](spark, folder)) <= 7


def test_a_late_birth_reaches_events_further_on(spark):
    """An activity makes a row 9 s after its detail's birth, which then waits 10 s for a coupon, across all cuts of time."""
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") + s)
    births = spark.range(0, 100)
    name = F.concat(F.lit("d"), F.col("id"))
    details = births.select(name.alias("id"), F.lit("o").alias("order_id"), at(0).alias("ts"))
    orders = births.select(F.lit("o").alias("id"), F.lit("u").alias("user_id"), F.lit("p").alias("province_id"), at(0).alias("ts"))
    activities = births.select(name.alias("order_detail_id"), F.lit("a").alias("activity_id"), F.lit("r").alias("activity_rule_id"), at(9).alias("ts"))
    coupons = births.select(name.alias("order_detail_id"), F.lit("c").alias("coupon_id"), at(18).alias("ts"))
    one = orders.where("ts = timestamp_seconds(1700000000)").unionAll(orders.where("ts = timestamp_seconds(1700000000)"))
    rows = changelog.emitted(changelog.wide_changelog(details.unionAll(details), one, activities, coupons, 10)).collect()
    got = {}
    for r in rows:
        got.setdefault(int(r.id[1:]), []).append((int(r["at"].ts.timestamp()) - 1_700_000_000 - int(r.id[1:]), r.sign, r.activity_id, r.coupon_id))
    expected = [(0, 1, None, None), (9, -1, None, None), (9, 1, "a", None), (18, -1, "a", None), (18, 1, "a", "c")]
    assert got.keys() == set(range(11))  # later details don't meet the order
    assert all(sorted(v, key=lambda e: e[:2]) == expected for v in got.values())


def reads_when_done(df, table: str) -> int:
    """Scans of a table in the plan as it ran; what reads another one's exchange isn't counted."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0].count(f"{table}.parquet")


@pytest.mark.parametrize("name", ["province_order_emissions", "sku_order_emissions"])
def test_signed_details_are_computed_once(spark, folder, name):
    """Running sums deal the rows once; the totals per slice come from the same exchange."""
    assert reads_when_done(QUERIES[name](spark, folder), "lineitem") == 1


def test_windows_of_a_province_are_dealt_once(spark, folder, no_broadcast):
    """Signed versions go through one exchange; counts of orders and sums need no further ones."""
    assert exchanges(QUERIES["province_order_emissions"](spark, folder)) <= 13


def test_cut_windows_are_the_whole_ones(inputs, same):
    """Orders with several details in a window, versions of a detail, and rows without a province."""
    details = inputs.detail_of_orders().drop("user_id", "sku_name").where("cast(order_id as bigint) <= 300")
    odd = details.withColumn("province_id", F.when(F.col("province_id") != "3", F.col("province_id")))
    more = odd.unionByName(odd.withColumns({"id": F.concat("id", F.lit("x")), "split_total_amount": F.lit(1).cast("decimal(16,2)")}))
    day = times.seconds_slice(F.col("ts"), 86_400)
    whole, cut = (trade.province_order_emissions(more, Inputs.DETAIL_ORDER, day, "90 days", hot_windows=h) for h in (False, True))
    assert whole.where("order_count > 1").count() > 100 and whole.where("province_id is null").count() > 10
    same(whole, cut)


@pytest.mark.parametrize("name", ["detail_emissions", "detail_emissions_year"])
def test_quiet_spells_deal_the_rows_once(spark, folder, name):
    assert exchanges(QUERIES[name](spark, folder)) <= 3


def test_lookup_as_of_deals_versions_and_facts_once(spark, folder):
    """The versions are reduced in one read of lineitem, the facts are the second, those without a key the third."""
    assert reads_when_done(QUERIES["detail_price_as_of"](spark, folder), "lineitem") == 3


def test_payment_detail_looks_up_what_was_paid(spark, folder):
    """Details meet the payments before anything is looked up for them."""
    text = plan(QUERIES["payment_detail"](spark, folder))
    assert "LeftSemi" in text


@pytest.mark.parametrize("name", ["label_scores_join", "label_max_bucket", "user_label"])
def test_labels_score_the_orders_of_users_with_a_device(spark, folder, name):
    """Orders are reduced to those users' before they meet their details."""
    assert plan(QUERIES[name](spark, folder)).count("LeftSemi") >= 2


def test_changelog_details_are_dealt_once(spark, folder):
    """The amounts go through one exchange; only ids meet the orders."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = plan(QUERIES["changelog_order_wide"](spark, folder)).splitlines()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [a for a, b in zip(lines, lines[1:]) if "Exchange hashpartitioning" in a and "split_total_amount" in b]
    assert len(dealt) == 1


def test_details_dealt_once_are_the_wide_details(spark, same):
    """Rows without ids, repeated details, a detail of two orders, orders in versions or unknown."""
    ids = [("d1", "o1"), ("d1", "o1"), ("d1", "o2"), ("d2", "o2"), (None, "o1"), (None, "o1"), (None, "o2"), ("", "o1"),
           (None, ""), ("", ""), ("d3", None), (None, None), ("d4", "o9"), ("oo1", "o1")]
    columns = "id string, order_id string, sku_id string, sku_name string, sku_num bigint, " + "".join(f"{a} double, " for a in facts.AMOUNTS)
    details = spark.createDataFrame([(*r, "s", "n", i, 1.0, 2.0, 3.0, 4.0, i) for i, r in enumerate(ids)], columns + "t bigint")
    details = details.withColumn("ts", F.timestamp_seconds("t")).drop("t")
    orders = spark.createDataFrame(
        [("o1", 1, "u0", "p0"), ("o1", 2, "u1", "p1"), ("o2", 1, None, "p2"), ("", 1, "u3", None), (None, 1, "u4", "p4")],
        "id string, ts bigint, user_id string, province_id string",
    )
    activities = spark.createDataFrame(
        [("d1", 1, "a0", "r0"), ("d1", 2, "a1", "r1"), ("", 1, "a2", None), (None, 1, "a3", "r3"), ("o1", 1, "a4", "r4")],
        "order_detail_id string, ts bigint, activity_id string, activity_rule_id string",
    )
    coupons = spark.createDataFrame([("d2", 1, "c"), ("oo1", 2, "c1"), (None, 1, "x")], "order_detail_id string, ts bigint, coupon_id string")
    plain, dealt = (facts.order_detail_wide(details, orders, activities, coupons, again) for again in (False, True))
    assert plain.count() == 11
    same(dealt, plain)
