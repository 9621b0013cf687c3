"""Order, cancel, payment, refund, cart and comment facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import times
from millrace.operators import cdc
from millrace.operators.joins import enrich, interval_join, prefixed, spread_lookup
from millrace.operators.running import latest_per_key

# Status codes of the source database.
UNPAID, PAID, CANCELLED, REFUNDING, REFUNDED = "1001", "1002", "1003", "1005", "1006"
PAYMENT_DONE, REFUND_DONE = "1602", "0705"

# A detail may be up to 30 minutes older and 5 seconds younger than its payment.
PAYMENT_LOWER, PAYMENT_UPPER = -30 * 60, 5

AMOUNTS = [
    "split_original_amount",
    "split_activity_amount",
    "split_coupon_amount",
    "split_total_amount",
]


def detail_extras(activities: DataFrame, coupons: DataFrame, **more: Column) -> DataFrame:
    """Latest activity and latest coupon per order detail, from one aggregate over both tables.

    ``more`` are further keys that follow from the detail's id.
    """
    activity = F.struct("ts", "activity_id", "activity_rule_id")
    coupon = F.struct("ts", "coupon_id")
    rows = activities.select("order_detail_id", activity.alias("activity")).unionByName(
        coupons.select("order_detail_id", coupon.alias("coupon")), allowMissingColumns=True
    )
    return rows.withColumns(more).groupBy("order_detail_id", *more).agg(
        F.max("activity").alias("activity"), F.max("coupon").alias("coupon")
    ).select("order_detail_id", *more, "activity.activity_id", "activity.activity_rule_id", "coupon.coupon_id")


def latest_orders(orders: DataFrame) -> DataFrame:
    """User and province of each order in its latest version; every status change sends a new one."""
    version = F.struct(*[c for c in ("ts", "user_id", "province_id") if c in orders.columns])
    latest = orders.groupBy("id").agg(F.max(version).alias("__version"))
    return latest.select("id", "__version.user_id", "__version.province_id")


def _dealt_once(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame) -> DataFrame:
    """Details with their extras and their order's user and province, dealt by detail alone.

    Only ids go to the orders; what they bring back goes to the details, once per detail and order. Details without
    an id have no extras and are dealt by their order.
    """
    known = details.where(F.col("order_id").isNotNull())
    key = F.coalesce("id", F.lit(""))
    alone = F.when(F.col("id").isNull(), F.concat(F.lit("o"), "order_id")).otherwise("")
    # Empty, but not a constant: the optimizer would drop the second key for one.
    empty = F.substring("order_detail_id", 1, 0)
    extras = detail_extras(activities, coupons, __alone=empty).where("order_detail_id IS NOT NULL")
    found = known.select("id", "order_id").join(latest_orders(orders).withColumnRenamed("id", "__order"), F.col("order_id") == F.col("__order"))
    found = found.select(key.alias("__key"), alone.alias("__by"), "__order", "user_id", "province_id")
    # Dealt by the first two, so that the join needs no exchange behind it.
    found = found.repartition("__key", "__by").dropDuplicates(["__key", "__by", "__order"])
    wide = known.join(extras, (key == F.col("order_detail_id")) & (alone == F.col("__alone")), "left")
    # The order is compared behind the keys: as a third key it would ask for another exchange.
    of_order = (F.col("order_id") <= F.col("__order")) & (F.col("order_id") >= F.col("__order"))
    return wide.join(found, (key == F.col("__key")) & (alone == F.col("__by")) & of_order)


def order_detail_wide(
    details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame, read_again: bool = False
) -> DataFrame:
    """Order details with the order's user and province and the detail's activity and coupon.

    Activity and coupon are taken in their latest version per detail, so a repeated detail never
    multiplies with repeated activities; the order is taken in its latest version, too. Activity and coupon
    come from one table by detail id, the order by order id: two shuffles of the details, nothing is counted
    before. Details that are cheap to read, as from a log, can be read again (``read_again``): their ids alone go to the
    orders then, and the rows themselves are shuffled once.
    """
    extras = ["activity_id", "activity_rule_id", "coupon_id"]
    if read_again:
        wide = _dealt_once(details, orders, activities, coupons)
    else:
        wide = spread_lookup(
            details, detail_extras(activities, coupons), {"id": "order_detail_id"}, {c: c for c in extras}
        )
        wide = spread_lookup(
            wide,
            latest_orders(orders),
            {"order_id": "id"},
            {"user_id": "user_id", "province_id": "province_id"},
            "inner",
        )
    return wide.select(
        "id",
        "order_id",
        "user_id",
        "sku_id",
        "sku_name",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        times.day_text(F.col("ts")).alias("date_id"),
        "sku_num",
        *AMOUNTS,
        "ts",
    )


def order_cancellations(changes: DataFrame) -> DataFrame:
    """Orders that went from unpaid to cancelled, once per order with the latest cancellation."""
    cancelled = cdc.status_became(changes, "order_info", "order_status", CANCELLED, UNPAID)
    at = times.millis_to_timestamp(F.col("after")["operate_time"].try_cast("bigint"))
    return cancelled.groupBy(F.col("after")["id"].alias("id")).agg(F.max(at).alias("operate_ts"))


def order_cancel_detail(wide: DataFrame, changes: DataFrame, within: Column | None = None) -> DataFrame:
    """Details of cancelled orders; an order is cancelled once.

    ``within`` is an optional condition on ``ts`` and ``operate_ts``, the retention of old details.
    """
    cancelled = order_cancellations(changes)
    joined = spread_lookup(wide, cancelled, {"order_id": "id"}, {"operate_ts": "operate_ts"}, "inner")
    if within is not None:
        joined = joined.where(within)
    return joined.select(
        "id",
        "order_id",
        "user_id",
        "sku_id",
        "province_id",
        "activity_id",
        "coupon_id",
        times.day_text(F.col("operate_ts")).alias("order_cancel_date_id"),
        "sku_num",
        *AMOUNTS,
        "operate_ts",
    )


def cart_adds(changes: DataFrame, include_inserts: bool = False) -> DataFrame:
    """Quantity put into the cart: the whole of a snapshot row, the growth of an update.

    Plain inserts are left out as the source job does, unless asked for.
    """
    new = F.col("after")["sku_num"].try_cast("int")
    old = F.col("before")["sku_num"].try_cast("int")
    grown = (F.col("op") == "u") & (new > old)
    whole = F.col("op") == "r"
    if include_inserts:
        whole = whole | (F.col("op") == "c")
    return cdc.of_table(changes, "cart_info").where(whole | grown).select(
        F.col("after")["id"].alias("id"),
        F.col("after")["user_id"].alias("user_id"),
        F.col("after")["sku_id"].alias("sku_id"),
        F.when(grown, new - old).otherwise(new).cast("bigint").alias("sku_num"),
        times.millis_to_timestamp(F.col("ts_ms")).alias("ts"),
    )


def details_in_reach(details: DataFrame, payments: DataFrame, lower: int = PAYMENT_LOWER, upper: int = PAYMENT_UPPER) -> DataFrame:
    """Details that :func:`payment_detail` finds a payment for, so that what they lack is looked up for these only."""
    calls = payments.select(F.col("order_id").alias("__order"), F.col("ts").alias("__callback")).dropna(subset=["__order"])
    width = max(upper - lower, 1) * 1_000_000

    def stretch(ts: str, shift: int) -> Column:
        return F.floor((F.unix_micros(F.col(ts)) + F.lit(shift * 1_000_000)) / F.lit(width)).cast("bigint")

    reach = calls.withColumn("__reach", F.explode(F.sequence(stretch("__callback", lower), stretch("__callback", upper))))
    gap = F.unix_micros("ts") - F.unix_micros("__callback")
    meets = (F.col("order_id") == F.col("__order")) & (stretch("ts", 0) == F.col("__reach"))
    return details.join(reach, meets & gap.between(lower * 1_000_000, upper * 1_000_000), "left_semi")


def payment_detail(
    details: DataFrame,
    payments: DataFrame,
    dictionary: DataFrame,
    lower: int = PAYMENT_LOWER,
    upper: int = PAYMENT_UPPER,
) -> DataFrame:
    """Paid order details: interval join of payment and detail, then the name of the payment type."""
    paid = payments.select(
        "order_id", F.md5("payment_type").alias("payment_type_code"), F.col("ts").alias("callback_ts")
    )
    detail = details.withColumnRenamed("id", "order_detail_id")
    joined = interval_join(paid, detail, ["order_id"], "callback_ts", "ts", lower, upper)
    named = enrich(
        joined,
        flat_dictionary(dictionary),
        {"payment_type_code": "dic_code"},
        {"dic_name": "payment_type_name"},
        "inner",
    )
    return named.select(
        "order_detail_id",
        "order_id",
        "user_id",
        "sku_id",
        "province_id",
        "activity_id",
        "coupon_id",
        "payment_type_code",
        "payment_type_name",
        "callback_ts",
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"),
    )


def flat_dictionary(dictionary: DataFrame) -> DataFrame:
    """Dictionary with its name out of the nested row."""
    return dictionary.select("dic_code", F.col("info.dic_name").alias("dic_name"))


def refund_payment_detail(refunds: DataFrame, refund_infos: DataFrame, orders: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refunds that succeeded, with refunded quantity, the order's user and the payment type name.

    The refund request is taken in its latest version per (order, sku).
    """
    request = latest_per_key(
        refund_infos.select("order_id", "sku_id", "refund_num", "ts", "id"), ["order_id", "sku_id"], ["ts", "id", "refund_num"]
    )
    joined = spread_lookup(
        refunds,
        request,
        {"order_id": "order_id", "sku_id": "sku_id"},
        {"refund_num": "refund_num"},
        "inner",
    )
    joined = spread_lookup(
        joined,
        orders,
        {"order_id": "id"},
        {"user_id": "user_id", "province_id": "province_id"},
        "inner",
    )
    coded = joined.withColumn("payment_type", F.md5("payment_type"))
    named = enrich(
        coded, flat_dictionary(dictionary), {"payment_type": "dic_code"}, {"dic_name": "payment_type_name"}, "inner"
    )
    return named.select(
        "id",
        "user_id",
        "order_id",
        "sku_id",
        "province_id",
        F.col("payment_type").alias("payment_type_code"),
        "payment_type_name",
        times.day_text(F.col("ts")).alias("date_id"),
        "refund_num",
        "total_amount",
        "ts",
    )


def refund_order_detail(refund_infos: DataFrame, orders: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refund requests with province and the names of type and reason from the same dictionary."""
    names = flat_dictionary(dictionary)
    joined = spread_lookup(refund_infos, orders, {"order_id": "id"}, {"province_id": "province_id"}, "inner")
    coded = joined.withColumns(
        {
            "refund_type_code": F.md5("refund_type"),
            "refund_reason_type_code": F.md5("refund_reason_type"),
        }
    )
    named = enrich(coded, names, {"refund_type_code": "dic_code"}, {"dic_name": "refund_type_name"}, "inner")
    named = enrich(
        named, names, {"refund_reason_type_code": "dic_code"}, {"dic_name": "refund_reason_type_name"}, "inner"
    )
    return named.select(
        "id",
        "user_id",
        "order_id",
        "sku_id",
        "province_id",
        times.day_text(F.col("ts")).alias("date_id"),
        "refund_type_code",
        "refund_type_name",
        "refund_reason_type_code",
        "refund_reason_type_name",
        "refund_reason_txt",
        "refund_num",
        "refund_amount",
        "ts",
    )


def comment_dic(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their rating; unknown ratings drop out."""
    coded = comments.withColumn("appraise", F.md5("appraise"))
    return enrich(coded, flat_dictionary(dictionary), {"appraise": "dic_code"}, {"dic_name": "appraise_name"}, "inner")


def comment_dic_left(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their rating, "N/A" where it is unknown."""
    coded = comments.withColumn("__code", F.md5("appraise"))
    named = enrich(coded, flat_dictionary(dictionary), {"__code": "dic_code"}, {"dic_name": "dic_name"})
    return named.withColumn("dic_name", F.coalesce("dic_name", F.lit("N/A"))).drop("__code")


def comment_order_interval(comments: DataFrame, orders: DataFrame, lower: int = -60, upper: int = 60) -> DataFrame:
    """Comments with their order (``info_`` columns) when both happened within the interval."""
    info = prefixed(orders, "info_").withColumn("order_id", F.col("info_id"))
    joined = interval_join(info, comments, ["order_id"], "info_ts", "ts", -upper, -lower)
    return joined.withColumn("ds", times.day_stamp(F.col("ts")))


def order_detail_interval(orders: DataFrame, details: DataFrame, lower: int = -120, upper: int = 120) -> DataFrame:
    """Orders with their details when both happened within the interval."""
    order = orders.select(
        F.col("id").alias("order_id"),
        F.col("user_id").alias("uid"),
        "consignee",
        "total_amount",
        F.col("ts").alias("create_ts"),
    )
    detail = details.select(
        F.col("id").alias("detail_id"),
        "order_id",
        "sku_id",
        "sku_name",
        "sku_num",
        "split_activity_amount",
        "split_coupon_amount",
        "split_total_amount",
        F.col("ts").alias("detail_ts"),
    )
    return interval_join(order, detail, ["order_id"], "create_ts", "detail_ts", lower, upper)
