"""The registered queries: each runs one operator over whole tables.

Results hold text, bigint and double columns only, so that another engine's result can be compared
value by value: money and scores are converted at the very end, dates and times are text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import keys, texts, times
from millrace.functions.sql import register_functions
from millrace.operators import (
    blooms,
    cdc,
    changelog,
    customers,
    dedup,
    facts,
    labels,
    logs,
    moderation,
    records,
    search,
    segments,
    tables,
    temporal,
    trade,
    traffic,
)
from millrace.operators.joins import broadcast_each_if_small
from millrace.plans.views import PROFILE_DAY, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAY = 86_400


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Inputs(spark, folder)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, timestamps and dates as text, integers as bigint, booleans as 0 / 1."""
    return df.select(*[_plain(f).alias(f.name) for f in df.schema.fields])


def _plain(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        return value.cast("double")
    if isinstance(field.dataType, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS")
    if isinstance(field.dataType, T.DateType):
        return times.day_text(value)
    if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.BooleanType)):
        return value.cast("bigint")
    return value


def day_slice(ts: str = "ts") -> Column:
    return times.seconds_slice(F.col(ts), DAY)


# --- page log ------------------------------------------------------------------------------------


@query
def log_parse_dirty(i: Inputs) -> DataFrame:
    parsed = logs.parse_json(i.raw_log(), schemas.PAGE_LOG)
    return parsed.select(
        "seq",
        "dirty",
        F.coalesce(F.col("record.common.mid"), F.lit("")).alias("mid"),
        F.coalesce(F.col("record.page.page_id"), F.lit("")).alias("page_id"),
        F.coalesce(F.col("record.ts"), F.lit(0)).alias("ts"),
        F.coalesce(F.size("record.displays"), F.lit(-1)).alias("displays"),
    )


@query
def log_parse_good(i: Inputs) -> DataFrame:
    parsed = logs.parse_json(logs.drop_null_messages(i.raw_log()), schemas.PAGE_LOG)
    return logs.good_records(parsed).select("seq", "ts", F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"))


@query
def log_split_err(i: Inputs) -> DataFrame:
    return logs.split_err(i.page_log())


@query
def log_split_start(i: Inputs) -> DataFrame:
    return logs.split_start(i.page_log()).select(
        "seq", F.col("common.mid").alias("mid"), "start.entry", "start.loading_time", "start.open_ad_id", "ts"
    )


@query
def log_split_display(i: Inputs) -> DataFrame:
    return logs.split_display(i.page_log()).select(
        "seq",
        F.col("common.mid").alias("mid"),
        "page.page_id",
        "display.item",
        "display.pos_id",
        "display.pos_seq",
        "ts",
    )


@query
def log_split_action(i: Inputs) -> DataFrame:
    return logs.split_action(i.page_log()).select(
        "seq",
        F.col("common.mid").alias("mid"),
        "page.page_id",
        "action.action_id",
        "action.item",
        F.col("action.ts").alias("action_ts"),
    )


@query
def log_split_page(i: Inputs) -> DataFrame:
    return logs.split_page(i.page_log()).select(
        "seq",
        F.col("common.mid").alias("mid"),
        F.col("common.vc").alias("vc"),
        "page.page_id",
        F.coalesce(F.col("page.last_page_id"), F.lit("")).alias("last_page_id"),
        "page.item",
        "page.during_time",
        "ts",
    )


@query
def fix_is_new(i: Inputs) -> DataFrame:
    return logs.fix_is_new(i.page_log()).select("seq", "common.mid", "common.is_new")


@query
def device_search_base(i: Inputs) -> DataFrame:
    return logs.device_search_base(i.page_log()).select(
        "seq", "uid", "ts", "device.os", "device.ch", "device.md", "device.ba",
        F.coalesce("search_item", F.lit("")).alias("search_item"),
    )


@query
def uv_flag(i: Inputs) -> DataFrame:
    return traffic.uv_flag(logs.page_views(i.page_log())).select("seq", "mid", "uv_ct", "sv_ct")


@query
def traffic_page_view_window(i: Inputs) -> DataFrame:
    return traffic.traffic_page_view_window(logs.page_views(i.page_log()))


@query
def home_detail_uv_window(i: Inputs) -> DataFrame:
    return traffic.home_detail_uv_window(logs.page_views(i.page_log()))


@query
def user_login_window(i: Inputs) -> DataFrame:
    return traffic.user_login_window(logs.page_views(i.page_log()))


@query
def keyword_window(i: Inputs) -> DataFrame:
    return traffic.keyword_window(logs.page_views(i.page_log()))


@query
def page_log_distinct(i: Inputs) -> DataFrame:
    base = logs.device_search_base(i.page_log())
    return dedup.distinct_records(
        base.select(
            "uid",
            times.day_text(F.col("ts")).alias("day"),
            "device.os",
            "device.md",
            F.coalesce("search_item", F.lit("")).alias("search_item"),
        )
    )


@query
def dedup_pair(i: Inputs) -> DataFrame:
    events = i.events().select("user_id", "k", "event_type", "ts_ms", "seq")
    return dedup.dedup_pair(events, "user_id", "k", ["ts_ms", "seq"])


@query
def dedup_pair_filtered(i: Inputs) -> DataFrame:
    """Pairs of the second half of the month that the first half doesn't have, and whether the filter kept its rate."""
    events = i.events().select("user_id", "k", "event_type", "ts_ms", "seq")
    middle = F.unix_millis(F.lit("2024-01-16").cast("timestamp"))
    fresh, figures = blooms.new_pairs(events.where(F.col("ts_ms") >= middle), events.where(F.col("ts_ms") < middle), "user_id", "k", ["ts_ms", "seq"])
    held = figures.select(F.coalesce((F.col("measured") <= 2 * F.col("asked")).cast("bigint"), F.lit(1).cast("bigint")))
    return fresh.withColumns({"rate_asked": F.lit(0.01), "rate_held": held.scalar()})


@query
def rows_to_json(i: Inputs) -> DataFrame:
    bean = i.events().select(
        F.col("seq").alias("eventSeq"), F.col("user_id").alias("userId"), F.col("event_type").alias("eventType")
    )
    return logs.rows_to_json(bean)


# --- changelog -----------------------------------------------------------------------------------


@query
def cdc_flatten(i: Inputs) -> DataFrame:
    flat = cdc.flatten(i.changes())
    return flat.withColumns({c: F.coalesce(c, F.lit("")) for c in ("before", "after")})


@query
def cdc_audit_latest(i: Inputs) -> DataFrame:
    audit = cdc.audit_latest(i.changes())
    return audit.select("table_name", "id_ts", "op", "ts", F.coalesce("after", F.lit("")).alias("after"))


@query
def cdc_row_image(i: Inputs) -> DataFrame:
    images = cdc.row_image(cdc.of_table(i.changes(), "order_info"))
    return images.select(
        "op",
        "table_name",
        F.col("image")["id"].alias("id"),
        F.col("image")["order_status"].alias("order_status"),
        F.col("image")["total_amount"].alias("total_amount"),
        "ts_ms",
    )


@query
def route_fact(i: Inputs) -> DataFrame:
    routed = cdc.route_fact(i.changes(), i.fact_config())
    return routed.withColumn("payload", keys.map_text(F.col("payload")))


@query
def route_fact_as_of(i: Inputs) -> DataFrame:
    """Facts by the configuration of their own time, which changes through the years."""
    routed = cdc.route_fact_as_of(i.changes(), i.config_history(), day_slice())
    return routed.withColumn("payload", keys.map_text(F.col("payload")))


@query
def config_current(i: Inputs) -> DataFrame:
    return cdc.config_current(i.config_changes(), "source_table", ["seq"])


@query
def dim_latest(i: Inputs) -> DataFrame:
    return cdc.dim_latest(i.sku_changes().unionByName(i.customer_changes()), i.dim_config())


@query
def dim_apply_changes(i: Inputs) -> DataFrame:
    table = i.table("part").select("p_partkey", "p_name", "p_brand")
    quantity = F.col("l_quantity").cast("bigint")
    updates = i.table("lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "d").otherwise("u").alias("op"),
        F.when(quantity % 2 == 0, "").otherwise(F.concat_ws(" ", F.lit("renamed"), F.col("l_suppkey").cast("string"))).alias("p_name"),
        F.col("l_shipdate").alias("at"),
        "l_orderkey",
        "l_linenumber",
        quantity.alias("quantity"),
    )
    return cdc.dim_apply_changes(table, updates, "p_partkey", ["at", "l_orderkey", "l_linenumber", "quantity", "p_name"])


@query
def dim_lookup(i: Inputs) -> DataFrame:
    wanted = i.table("lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("p_partkey"))
    return cdc.dim_lookup(i.table("part").select("p_partkey", "p_name", "p_brand"), wanted, "p_partkey")


@query
def upsert_latest(i: Inputs) -> DataFrame:
    target = i.table("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").cast("decimal(16,2)").alias("amount"),
        F.lit("1990-01-01").cast("timestamp").alias("updated_at"),
        F.lit(-1).cast("bigint").alias("seq"),
    )
    updates = i.table("orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
    )
    return cdc.upsert_latest(target, updates, ["user_id"], ["updated_at", "seq"])


@query
def day_bucket(i: Inputs) -> DataFrame:
    """Rows per day partition; the time comes in seconds, in milliseconds or not as a number."""
    stamped = i.events().select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("ts_ms").cast("string")))
        .when(F.col("event_type") == "view", F.floor(F.col("ts_ms") / 1000).cast("string"))
        .otherwise(F.col("ts_ms").cast("string"))
        .alias("at"),
    )
    return cdc.day_bucket(stamped, "at").groupBy("day").agg(F.count(F.lit(1)).alias("row_count"))


@query
def order_paid_transition(i: Inputs) -> DataFrame:
    """Orders whose status became paid from any known status."""
    paid = cdc.status_became(i.changes(), "order_info", "order_status", facts.PAID)
    return records.order_records(paid).select("id", "user_id", "total_amount", "ts")


@query
def order_detail_records(i: Inputs) -> DataFrame:
    return records.order_detail_records(i.changes()).select("id", "order_id", "sku_id", "sku_num", "ts")


@query
def user_records(i: Inputs) -> DataFrame:
    return records.user_records(i.changes()).select("uid", "uname", "gender", "ts")


# --- facts ---------------------------------------------------------------------------------------


def _wide(i: Inputs) -> DataFrame:
    return facts.order_detail_wide(i.order_detail(), i.order_info(), i.activities(), i.coupons())


def _no_nulls(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.coalesce(n, F.lit("")) for n in names})


@query
def order_detail_wide(i: Inputs) -> DataFrame:
    return _no_nulls(_wide(i), "activity_id", "activity_rule_id", "coupon_id")


def _wide_emissions(i: Inputs, life: int) -> DataFrame:
    # The sku's name follows from its id.
    rows = changelog.wide_changelog(i.order_detail().drop("sku_name"), i.order_info(), i.activities(), i.coupons(), life)
    out = changelog.emitted(rows).select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "sku_num",
        "split_total_amount", "sign", F.col("at.side").alias("side"), F.col("at.ts").alias("at_ts"),
    )
    return _no_nulls(out, "activity_id", "activity_rule_id", "coupon_id")


@query
def wide_changelog(i: Inputs) -> DataFrame:
    """All that the join of four streams emits and takes back, with state that outlives the tables' time."""
    return _wide_emissions(i, 3_650 * DAY)


@query
def wide_changelog_expiring(i: Inputs) -> DataFrame:
    """The same with state of 60 days: what comes later finds nothing to join."""
    return _wide_emissions(i, 60 * DAY)


@query
def detail_price_as_of(i: Inputs) -> DataFrame:
    """Details with the sku's price and supplier as they were some hours before the detail's time."""
    asked = F.col("ts") - F.make_dt_interval(hours=F.col("sku_num").cast("int"))
    facts_of = i.order_detail().select("id", "order_id", "sku_id", "sku_num", asked.alias("asked_ts"))
    found = temporal.lookup_as_of(
        facts_of, i.sku_versions(), {"sku_id": "sku_id"}, "asked_ts", "ts", ["op", "price", "supplier"],
        {"price": "price", "supplier": "supplier"}, day_slice(), F.col("op") == "d",
    )
    shown = found.withColumn("price", F.coalesce("price", F.lit(0).cast("decimal(16,2)")))
    return _no_nulls(shown.select("id", "order_id", "sku_id", "sku_num", "asked_ts", "price", "supplier"), "supplier")


@query
def snapshot_handover(i: Inputs) -> DataFrame:
    """Orders read in chunks while their log goes on, then the log."""
    out = temporal.snapshot_handover(i.order_snapshot(), i.order_log(), i.order_marks(), "id")
    return out.select(
        "op", "id", "seq", F.coalesce(F.col("after")["order_status"], F.lit("")).alias("order_status"),
        F.coalesce(F.col("after")["total_amount"], F.lit("")).alias("total_amount"),
    )


def _wide_of_changes(changes: DataFrame, read_again: bool = False) -> DataFrame:
    """Wide details out of a changelog of the four tables."""
    details = records.order_detail_records(changes)
    orders = records.order_records(changes)
    return facts.order_detail_wide(
        details, orders, records.activity_records(changes), records.coupon_records(changes), read_again
    )


@query
def changelog_order_wide(i: Inputs) -> DataFrame:
    """From the changelog through typed records to wide details; orders come in two versions."""
    return _no_nulls(_wide_of_changes(i.fact_changes(), read_again=True), "activity_id", "activity_rule_id", "coupon_id")


@query
def changelog_payment(i: Inputs) -> DataFrame:
    """Payments out of the changelog, with the wide details out of the changelog."""
    payments = records.payment_records(i.payment_changes()).select("order_id", "payment_type", "ts")
    paid = facts.payment_detail(_wide_of_changes(i.fact_changes()), payments, i.dictionary(), -30 * DAY, 5 * DAY)
    return paid.select("order_detail_id", "order_id", "user_id", "payment_type_name", "callback_ts", "sku_num", "split_payment_amount")


@query
def changelog_refund(i: Inputs) -> DataFrame:
    """Refund requests out of the changelog, with their orders."""
    refunding = i.order_info().where(F.col("status") == "O")
    return facts.refund_order_detail(records.refund_request_records(i.refund_changes()), refunding, i.dictionary())


@query
def changelog_comment_dic(i: Inputs) -> DataFrame:
    """Comments out of the changelog, with the name of their rating."""
    comments = records.comment_records(i.comment_changes())
    return facts.comment_dic(comments, i.dictionary()).select("id", "user_id", "appraise", "appraise_name", "msg", "table_name")


@query
def order_cancel_detail(i: Inputs) -> DataFrame:
    return _no_nulls(facts.order_cancel_detail(_wide(i), i.changes()), "activity_id", "coupon_id")


@query
def cart_add_detail(i: Inputs) -> DataFrame:
    return facts.cart_adds(i.cart_changes())


@query
def cart_uu_window(i: Inputs) -> DataFrame:
    return traffic.cart_uu_window(facts.cart_adds(i.cart_changes()))


@query
def payment_detail(i: Inputs) -> DataFrame:
    """Interval of 30 days before to 5 days after, in the data's scale of days."""
    reached = facts.details_in_reach(i.order_detail(), i.payments(), -30 * DAY, 5 * DAY)
    wide = facts.order_detail_wide(reached, i.order_info(), i.activities(), i.coupons())
    paid = facts.payment_detail(wide, i.payments(), i.dictionary(), -30 * DAY, 5 * DAY)
    return _no_nulls(paid, "activity_id", "coupon_id")


@query
def refund_payment_detail(i: Inputs) -> DataFrame:
    done = i.order_info().where(F.col("status") == "F")
    return facts.refund_payment_detail(i.refund_payments(), i.refund_infos(), done, i.dictionary())


@query
def refund_order_detail(i: Inputs) -> DataFrame:
    refunding = i.order_info().where(F.col("status") == "O")
    return facts.refund_order_detail(i.refund_infos(), refunding, i.dictionary())


@query
def comment_dic(i: Inputs) -> DataFrame:
    return facts.comment_dic(i.comments(), i.dictionary()).select("id", "user_id", "appraise", "appraise_name", "msg")


@query
def comment_dic_left(i: Inputs) -> DataFrame:
    return facts.comment_dic_left(i.comments(), i.dictionary()).select("id", "user_id", "appraise", "dic_name")


@query
def comment_order_interval(i: Inputs) -> DataFrame:
    """Interval of 400 days to both sides, in the data's scale of days."""
    joined = facts.comment_order_interval(i.comments(), i.order_info(), -400 * DAY, 400 * DAY)
    return joined.select("id", "order_id", "ts", "ds", "info_user_id", "info_consignee", "info_total_amount", "info_ts")


@query
def order_detail_interval(i: Inputs) -> DataFrame:
    return facts.order_detail_interval(i.label_orders(), i.label_details())


@query
def detail_latest_only(i: Inputs) -> DataFrame:
    return _newest_details(i)


ARRIVAL = ["detail_ts", "sku_id", "sku_num", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def _newest_details(i: Inputs, of_users: DataFrame | None = None) -> DataFrame:
    """``of_users`` (column uid) leaves out orders that were never one of theirs; a detail's id tells its order."""
    orders = i.label_orders()
    if of_users is not None:
        own = orders.join(of_users.select(F.col("uid").alias("user_id")).distinct(), "user_id", "left_semi").select("id")
        orders = orders.join(own, "id", "left_semi")
    joined = facts.order_detail_interval(orders, i.label_details())
    return dedup.newest_only(joined, "detail_id", "create_ts", ARRIVAL, day_slice("detail_ts"))


@query
def user_latest_only(i: Inputs) -> DataFrame:
    """Order key stands for arrival, order date for the version of the user record."""
    arrivals = i.table("orders").select(
        "o_custkey", "o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms")
    )
    by_position = F.floor(F.col("o_orderkey") / 1_000_000).cast("bigint")
    return dedup.newest_only(arrivals, "o_custkey", "ts_ms", ["o_orderkey"], by_position)


# --- trade ---------------------------------------------------------------------------------------


@query
def retract_dedup(i: Inputs) -> DataFrame:
    signed = dedup.retract_dedup(
        i.order_detail(), "id", Inputs.DETAIL_ORDER, facts.AMOUNTS, day_slice()
    )
    return signed.select("id", "sku_id", "sku_num", *facts.AMOUNTS, "sign", "ts")


@query
def detail_latest_held(i: Inputs) -> DataFrame:
    """The last version of each detail."""
    held = dedup.latest_held(i.order_detail(), "id", Inputs.DETAIL_ORDER)
    return held.select("id", "sku_id", "sku_num", "split_total_amount", "ts")


def _quiet_spells(i: Inputs, quiet: int) -> DataFrame:
    spells = temporal.emissions_after_quiet(i.order_detail().select("id", *Inputs.DETAIL_ORDER), "id", "ts", Inputs.DETAIL_ORDER, quiet, day_slice())
    return spells.select("id", "sku_id", "sku_num", "split_total_amount", "ts", "emit_ts")


@query
def detail_emissions(i: Inputs) -> DataFrame:
    """Each detail's version held when nothing came for 5 seconds."""
    return _quiet_spells(i, 5)


@query
def detail_emissions_year(i: Inputs) -> DataFrame:
    """The same with a wait of 365 days, in which several versions fall."""
    return _quiet_spells(i, 365 * DAY)


@query
def province_order_emissions(i: Inputs) -> DataFrame:
    # The sku's name follows from its id.
    return trade.province_order_emissions(i.detail_of_orders().drop("user_id", "sku_name"), Inputs.DETAIL_ORDER, day_slice())


@query
def sku_order_emissions(i: Inputs) -> DataFrame:
    # The order follows from the detail's id, the sku's name from the sku's.
    return trade.sku_order_emissions(i.order_detail().drop("order_id", "sku_name"), Inputs.DETAIL_ORDER, day_slice())


@query
def sku_order_window(i: Inputs) -> DataFrame:
    return trade.sku_order_window(i.order_detail(), Inputs.DETAIL_ORDER)


@query
def province_order_window(i: Inputs) -> DataFrame:
    return trade.province_order_window(i.detail_of_orders(), i.provinces(), Inputs.DETAIL_ORDER)


@query
def sku_dim_chain(i: Inputs) -> DataFrame:
    """Amounts per sku and day, then the six lookups."""
    summed = trade.sku_order_window(i.order_detail(), Inputs.DETAIL_ORDER, "1 day")
    small = broadcast_each_if_small(
        [i.spu(), i.trademark(), i.category3(), i.category2(), i.category1()]
    )
    chained = trade.sku_dim_chain(summed, i.sku(), *small)
    return _no_nulls(
        chained.select(
            "stt", "sku_id", "sku_name", "spu_id", "spu_name", "trademark_id", "trademark_name",
            "category3_id", "category3_name", "category2_id", "category2_name", "category1_id",
            "category1_name", "order_amount",
        ),
        "category1_name",
    )


@query
def category_hierarchy(i: Inputs) -> DataFrame:
    return trade.category_hierarchy(i.category3(), i.category2(), i.category1())


@query
def sku_snapshot(i: Inputs) -> DataFrame:
    return trade.sku_snapshot(i.sku(), *broadcast_each_if_small([i.spu(), i.trademark()]))


# --- shop customers ------------------------------------------------------------------------------


def _clean(i: Inputs) -> DataFrame:
    return customers.clean(i.shop_actions())


@query
def shop_actions_clean(i: Inputs) -> DataFrame:
    cleaned = _clean(i).select("action_id", "user_id", "shop_id", "stat_date", "action_type", "amount", "related_id")
    return cleaned.withColumns(
        {"amount": F.coalesce("amount", F.lit(0)), "related_id": F.coalesce("related_id", F.lit(""))}
    )


@query
def shop_actions_invalid(i: Inputs) -> DataFrame:
    return customers.invalid(i.shop_actions())


@query
def shop_actions_by_type(i: Inputs) -> DataFrame:
    types = (customers.VISIT, customers.INTERACTION, customers.PAYMENT, customers.FOLLOW)
    split = _clean(i).where(F.col("action_type").isin(*types))
    return split.groupBy("action_type", "shop_id").agg(F.count(F.lit(1)).alias("action_count"))


@query
def new_visit_events(i: Inputs) -> DataFrame:
    return customers.new_visit_events(_clean(i))


@query
def new_visit_events_3d(i: Inputs) -> DataFrame:
    """The same rule with a pause of 3 days, which the data reaches."""
    return customers.new_visit_events(_clean(i), period_days=3)


@query
def return_visit_events(i: Inputs) -> DataFrame:
    return customers.return_visit_events(_clean(i))


@query
def old_customer_events(i: Inputs) -> DataFrame:
    return customers.old_customer_events(_clean(i))


@query
def old_customer_events_3d(i: Inputs) -> DataFrame:
    """The same rule with a period of 3 days, which expires in the data."""
    return customers.old_customer_events(_clean(i), period_days=3)


@query
def new_visit_metrics(i: Inputs) -> DataFrame:
    return customers.new_visit_metrics(customers.new_visit_events(_clean(i)))


@query
def return_visit_metrics(i: Inputs) -> DataFrame:
    return customers.return_visit_metrics(customers.return_visit_events(_clean(i)))


@query
def old_customer_metrics(i: Inputs) -> DataFrame:
    return customers.old_customer_metrics(customers.old_customer_events(_clean(i)))


@query
def shop_customer_day(i: Inputs) -> DataFrame:
    return customers.shop_customer_day(_clean(i))


@query
def shop_sales_day(i: Inputs) -> DataFrame:
    return customers.shop_sales_day(customers.segmented_sales(_clean(i)))


@query
def segment_payment_ratio(i: Inputs) -> DataFrame:
    return customers.segment_payment_ratio(customers.shop_sales_day(customers.segmented_sales(_clean(i))))


# --- search --------------------------------------------------------------------------------------


@query
def search_log_clean(i: Inputs) -> DataFrame:
    return search.search_log_clean(i.search_lines()).drop("ts")


@query
def query_count_window(i: Inputs) -> DataFrame:
    return search.query_count_window(search.search_log_clean(i.search_lines()))


@query
def hot_query_topn(i: Inputs) -> DataFrame:
    return search.hot_query_topn(search.query_count_window(search.search_log_clean(i.search_lines())))


@query
def hot_query_changes(i: Inputs) -> DataFrame:
    """What entered, left or moved in the ten most searched queries, window by window."""
    return search.hot_query_changes(search.query_count_window(search.search_log_clean(i.search_lines())))


@query
def search_records(i: Inputs) -> DataFrame:
    """Goods log lines renamed into search records."""
    return search.search_records(search.parse_goods_log(i.goods_lines())).drop("ts")


@query
def keyword_udtf(i: Inputs) -> DataFrame:
    """The word splitter as a table function in SQL, over all user and assistant turns."""
    register_functions(i.spark)
    i.table("conversations").createOrReplaceTempView("millrace_conversations")
    return i.spark.sql(
        """
        SELECT c.role, w.word, count(*) AS word_count
        FROM millrace_conversations c, LATERAL keywordUDTF(c.text) w
        GROUP BY c.role, w.word
        """
    )


@query
def keyword_segments(i: Inputs) -> DataFrame:
    """Words of the conversations' turns as found without their blanks, by role; the dictionary is counted from them."""
    turns = i.table("conversations").select("role", "text")
    words = segments.dictionary(turns.select(F.explode(texts.words(F.col("text"))).alias("word")))
    runs = turns.select("role", F.explode(segments.runs(F.col("text"))).alias("run"))
    counted = runs.groupBy("role", "run").agg(F.count(F.lit(1)).alias("n"))
    # Its letters are counted without an exchange if the runs aren't.
    cut = segments.segmented(runs, words)
    found = counted.join(cut, "run").select("role", "n", F.explode("words").alias("keyword"))
    return found.groupBy("role", "keyword").agg(F.sum("n").alias("keyword_count"))


@query
def keyword_tokens(i: Inputs) -> DataFrame:
    """Words of all documents, counted per language."""
    tokens = traffic.keyword_tokens(i.table("documents"), "text", ["lang"])
    return tokens.groupBy("lang", "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))


# --- moderation ----------------------------------------------------------------------------------


@query
def comment_blacklist(i: Inputs) -> DataFrame:
    flagged = moderation.comment_blacklist(i.comments(), moderation.word_table(i.words()))
    return flagged.select("id", "last_word", "is_violation")


@query
def comment_moderation(i: Inputs) -> DataFrame:
    graded = moderation.comment_moderation(i.comments(), moderation.word_table(i.words()), "id")
    return graded.select("id", "is_violation", "violation_grade", "violation_msg")


@query
def ban_list(i: Inputs) -> DataFrame:
    return moderation.ban_list(i.comments(), moderation.word_table(i.words()))


# --- labels --------------------------------------------------------------------------------------


def _device_rows(i: Inputs) -> DataFrame:
    return labels.user_device_latest_window(logs.device_search_base(i.page_log()))


def _searched(i: Inputs) -> DataFrame:
    small = broadcast_each_if_small([i.search_categories(), i.search_compare()])
    return labels.score_search(labels.score_device(_device_rows(i)), *small)


BRAND_GROUPS = {
    "A": [f"brand#{n}" for n in range(5, 26, 5)],
    "B": [f"brand#{n}" for n in range(1, 26, 5)],
    "C": [f"brand#{n}" for n in range(2, 26, 5)],
    "D": [f"brand#{n}" for n in range(3, 26, 5)],
}
CATEGORY_GROUPS = {"1": ["c1-0"], "2": ["c1-1"]}


def _order_rows(i: Inputs, of_users: DataFrame | None = None) -> DataFrame:
    return _with_dimensions(i, _newest_details(i, of_users))


def _order_scores(i: Inputs, of_users: DataFrame | None = None) -> DataFrame:
    scored = labels.score_amount(labels.score_time(labels.pay_time_slot(_order_rows(i, of_users))))
    scored = labels.score_category(labels.score_brand(scored, groups=BRAND_GROUPS), groups=CATEGORY_GROUPS)
    return scored.select(
        "uid",
        F.col("create_ts").alias("ts"),
        "detail_id",
        "sku_id",
        "sku_name",
        "tname",
        "b1_name",
        "pay_time_slot",
        "spending_pow",
        *[c for f in ("time", "amount", "brand", "category") for c in labels.score_columns(f)],
    )


def _joined_scores(i: Inputs) -> DataFrame:
    # Orders meet devices by their user, so those of users without a device need no dimensions and no scores.
    seen = logs.device_search_base(i.page_log()).select("uid")
    return labels.label_scores_join(_searched(i), _order_scores(i, seen))


SUMS = [f"sum_{b}" for b in labels.BUCKETS]


@query
def user_device_rollup(i: Inputs) -> DataFrame:
    return labels.user_device_rollup(logs.device_search_base(i.page_log()))


@query
def user_device_values(i: Inputs) -> DataFrame:
    return labels.user_device_values(logs.device_search_base(i.page_log()))


@query
def label_merge(i: Inputs) -> DataFrame:
    """User rows merged with the body measures reported, and the day of the report."""
    users = i.users().select("uid", "uname", "user_level", F.coalesce("gender", F.lit("home")).alias("gender"))
    return labels.merge_labels(users, i.supplements(), "uid")


@query
def user_device_running(i: Inputs) -> DataFrame:
    """Views and different devices, channels and phrases of a user after each event."""
    return labels.user_device_running(logs.device_search_base(i.page_log()), day_slice())


@query
def user_device_latest_window(i: Inputs) -> DataFrame:
    return _no_nulls(_device_rows(i), "search_item")


@query
def score_device(i: Inputs) -> DataFrame:
    return labels.score_device(_device_rows(i)).select("uid", "ts", "judge_os", *labels.score_columns("device"))


@query
def score_search(i: Inputs) -> DataFrame:
    scored = _searched(i).select("uid", "ts", "search_item", "search_category", *labels.score_columns("search"))
    return _no_nulls(scored, "search_item", "search_category")


@query
def pay_time_slot(i: Inputs) -> DataFrame:
    return labels.pay_time_slot(i.label_orders(), "ts").select("id", "user_id", "ts", "pay_time_slot")


@query
def score_time(i: Inputs) -> DataFrame:
    slotted = labels.pay_time_slot(i.label_orders(), "ts")
    return labels.score_time(slotted).select("id", "pay_time_slot", *labels.score_columns("time"))


@query
def score_amount(i: Inputs) -> DataFrame:
    return labels.score_amount(i.label_orders()).select("id", "spending_pow", *labels.score_columns("amount"))


def _with_dimensions(i: Inputs, details: DataFrame) -> DataFrame:
    """Details with brand and top category."""
    hierarchy = trade.category_hierarchy(i.category3(), i.category2(), i.category1())
    snapshot = trade.sku_snapshot(i.sku(), i.spu(), i.trademark())
    return labels.order_dimensions(details, snapshot, hierarchy)


@query
def score_named_groups(i: Inputs) -> DataFrame:
    """Brand and category scores with the groups of real brands and categories, dealt over the skus."""

    def dealt(groups: dict[str, list[str]]) -> Column:
        names = [m for members in groups.values() for m in members] + ["无"]
        return F.array(*map(F.lit, names))[(F.col("sku_id").cast("bigint") % len(names)).cast("int")]

    named = i.order_detail().select("id", dealt(labels.BRAND_GROUPS).alias("tname"), dealt(labels.CATEGORY_GROUPS).alias("b1_name"))
    brands = labels.score_brand(named, groups=labels.BRAND_GROUPS)
    both = labels.score_category(brands, groups=labels.CATEGORY_GROUPS)
    return both.select("id", "tname", "b1_name", *labels.score_columns("brand"), *labels.score_columns("category"))


@query
def score_brand(i: Inputs) -> DataFrame:
    scored = labels.score_brand(_with_dimensions(i, i.order_detail()), groups=BRAND_GROUPS)
    return scored.select("id", "sku_id", "sku_num", "ts", "tname", *labels.score_columns("brand"))


@query
def score_category(i: Inputs) -> DataFrame:
    scored = labels.score_category(_with_dimensions(i, i.order_detail()), groups=CATEGORY_GROUPS)
    return scored.select("id", "sku_id", "sku_num", "ts", "b1_name", *labels.score_columns("category"))


@query
def user_profile(i: Inputs) -> DataFrame:
    return labels.user_profile(i.users(), F.lit(PROFILE_DAY).cast("date"))


def _profiles(i: Inputs) -> DataFrame:
    return labels.user_profile_interval(labels.user_profile(i.users(), F.lit(PROFILE_DAY).cast("date")), i.supplements())


@query
def user_profile_interval(i: Inputs) -> DataFrame:
    return _profiles(i).select("uid", "uname", "gender", "age", "zodiac_sign", "height", "weight", "ts", "sup_ts")


@query
def label_scores_join(i: Inputs) -> DataFrame:
    return _joined_scores(i).select("uid", "ts", "detail_id", "order_ts", *SUMS)


@query
def label_max_bucket(i: Inputs) -> DataFrame:
    return labels.label_max_bucket(_joined_scores(i)).select(
        "uid", "ts", "detail_id", "order_ts", "best_bucket", "best_score"
    )


@query
def user_label(i: Inputs) -> DataFrame:
    label = labels.user_label(_joined_scores(i), _profiles(i))
    flat = label.select(
        "uid",
        "uname",
        "ts",
        "ds",
        "user_base_label.decade",
        "user_base_label.zodiac_sign",
        "user_base_label.height",
        "user_base_label.judge_os",
        "user_base_label.base_age",
        "user_log_label.intraday_pv",
        "user_log_label.search_item",
        "user_device_label.login_time_slot",
        "user_calculate_label.computer_age_info.age_sum18_24",
        "user_calculate_label.spending_pow",
        "user_calculate_label.calculate_age.best_bucket",
        "sup_info_message.sku_id",
        "sup_info_message.b1_name",
    )
    return _no_nulls(flat, "search_item", "b1_name")


# --- whole-table reports -------------------------------------------------------------------------


@query
def text_charset_quality(i: Inputs) -> DataFrame:
    return tables.text_charset_quality(i.table("documents"), "text", ["source", "lang"])


@query
def hash_bucket_skew(i: Inputs) -> DataFrame:
    return tables.hash_bucket_skew(i.table("lineitem"), F.col("l_orderkey"))


@query
def row_key_table(i: Inputs) -> DataFrame:
    keyed = i.table("lineitem").select(
        keys.row_key(F.col("l_orderkey"), F.col("l_linenumber"), hash_key=True).alias("row_key")
    )
    return tables.row_key_duplicates(keyed)


@query
def daily_metric_filled(i: Inputs) -> DataFrame:
    """Pages with an item on sale per user and day; most users miss days."""
    day = F.to_date(times.millis_to_timestamp(F.col("ts_ms")))
    metric = i.events().groupBy("user_id", day.alias("day")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.col("value").cast("decimal(16,2)")).cast("decimal(16,2)").alias("value_sum"),
    )
    filled = tables.daily_metric_filled(metric, "day", ["user_id"], ["event_count", "value_sum"])
    return filled.withColumn("day", times.day_stamp(F.col("day")))
