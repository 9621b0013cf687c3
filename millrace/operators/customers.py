"""Shop customers: clean actions, new / returning / old segments, daily metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import times
from millrace.operators.running import Running, running

VISIT, INTERACTION, PAYMENT, FOLLOW = "VISIT", "INTERACTION", "PAYMENT", "FOLLOW"

# Fixed values.
NEW_AFTER_DAYS = 30
OLD_WITHIN_DAYS = 365
MEMBER_AMOUNT = 5000
MEMBER_PURCHASES = 3
INTERACTION_BELOW_SECONDS = 3

# Width of the stretches a (shop, user) pair is cut into, see operators.running.
SLICE_SECONDS = 3600


def standardise(actions: DataFrame) -> DataFrame:
    """Typed actions with a reason where one is not valid.

    A like within the first seconds of a short video is the only interaction that counts.
    """
    kind = F.col("action_type")
    core_missing = (
        F.col("user_id").isNull()
        | F.col("shop_id").isNull()
        | F.coalesce(F.col("ts_ms") <= 0, F.lit(True))
        | kind.isNull()
    )
    like_missing = F.col("duration").isNull() | F.col("liked").isNull() | F.col("content_id").isNull()
    like_counts = (F.col("duration") < INTERACTION_BELOW_SECONDS) & F.col("liked")
    pay_missing = F.col("amount").isNull() | F.col("order_id").isNull()
    reason = (
        F.when(core_missing, "missing core field")
        .when(kind == "visit", None)
        .when((kind == "interact") & like_missing, "missing interaction field")
        .when((kind == "interact") & ~like_counts, "interaction does not count")
        .when(kind == "interact", None)
        .when((kind == "purchase") & pay_missing, "missing payment field")
        .when(kind == "purchase", None)
        .when(kind == "follow", None)
        .otherwise("unknown action type")
    )
    standard = (
        F.when(kind == "visit", VISIT)
        .when(kind == "interact", INTERACTION)
        .when(kind == "purchase", PAYMENT)
        .when(kind == "follow", FOLLOW)
    )
    related = F.when(kind == "interact", F.col("content_id")).when(kind == "purchase", F.col("order_id"))
    ts = times.millis_to_timestamp(F.col("ts_ms"))
    return actions.select(
        "action_id",
        "user_id",
        "shop_id",
        "seq",
        ts.alias("ts"),
        times.day_text(ts).alias("stat_date"),
        F.col("action_type").alias("raw_type"),
        standard.alias("action_type"),
        F.when(kind == "purchase", F.col("amount")).alias("amount"),
        related.alias("related_id"),
        reason.alias("invalid_reason"),
    )


def clean(actions: DataFrame) -> DataFrame:
    return standardise(actions).where(F.col("invalid_reason").isNull()).drop("invalid_reason", "raw_type")


def invalid(actions: DataFrame) -> DataFrame:
    return standardise(actions).where(F.col("invalid_reason").isNotNull()).select(
        "action_id", "raw_type", "invalid_reason"
    )


def of_type(cleaned: DataFrame, action_type: str) -> DataFrame:
    return cleaned.where(F.col("action_type") == action_type)


# --- segments ------------------------------------------------------------------------------------


def _with_history(cleaned: DataFrame, slice_seconds: int) -> DataFrame:
    """What is known of (shop, user) before each action, and totals including it."""
    paid = F.col("action_type") == PAYMENT
    return running(
        cleaned,
        ["shop_id", "user_id"],
        ["ts", "seq"],
        times.seconds_slice(F.col("ts"), slice_seconds),
        [
            Running("__prior_purchases", "sum", paid.cast("bigint")),
            Running("__last_ts", "max", F.col("ts")),
            Running("__last_purchase", "max", F.when(paid, F.col("ts"))),
            Running("__followed", "max", (F.col("action_type") == FOLLOW).cast("int"), through=True),
            Running("total_purchase_count", "sum", paid.cast("bigint"), through=True),
            Running(
                "total_purchase_amount",
                "sum",
                F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(16,2)"),
                through=True,
            ),
        ],
    )


def _days_after(ts: Column, earlier: Column, days: int) -> Column:
    return F.unix_micros(ts) - F.unix_micros(earlier) > days * 86_400_000_000


def _events(history: DataFrame, condition: Column) -> DataFrame:
    paid = (F.col("action_type") == PAYMENT).cast("bigint")
    return history.where(condition).select(
        "shop_id",
        "stat_date",
        "user_id",
        "seq",
        "ts",
        paid.alias("paid_count"),
        (1 - paid).alias("unpaid_count"),
        F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(16,2)").alias("payment_amount"),
        (F.col("__followed") == 1).alias("followed"),
        "total_purchase_count",
        F.col("total_purchase_amount").cast("decimal(16,2)").alias("total_purchase_amount"),
    )


def is_new_visit(period_days: int) -> Column:
    """Never bought before, and first action or a long pause."""
    return (F.col("__prior_purchases") == 0) & (
        F.col("__last_ts").isNull() | _days_after(F.col("ts"), F.col("__last_ts"), period_days)
    )


def is_return_visit() -> Column:
    """Acted before, never bought before."""
    return (F.col("__prior_purchases") == 0) & F.col("__last_ts").isNotNull()


def is_old_customer(period_days: int) -> Column:
    """The last purchase lies within the period."""
    return F.col("__last_purchase").isNotNull() & ~_days_after(
        F.col("ts"), F.col("__last_purchase"), period_days
    )


def new_visit_events(cleaned: DataFrame, period_days: int = NEW_AFTER_DAYS, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    return _events(_with_history(cleaned, slice_seconds), is_new_visit(period_days))


def return_visit_events(cleaned: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    return _events(_with_history(cleaned, slice_seconds), is_return_visit())


def old_customer_events(cleaned: DataFrame, period_days: int = OLD_WITHIN_DAYS, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    return _events(_with_history(cleaned, slice_seconds), is_old_customer(period_days))


def segmented_sales(
    cleaned: DataFrame,
    new_days: int = NEW_AFTER_DAYS,
    old_days: int = OLD_WITHIN_DAYS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Payments with the segments they fall in, from one pass over the history.

    A first purchase after a long pause is both a new and a return visit, as in the segment rules.
    """
    history = _with_history(cleaned, slice_seconds).where(F.col("action_type") == PAYMENT)
    amount = F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(16,2)")
    none = F.lit(0).cast("decimal(16,2)")
    return history.select(
        "shop_id",
        "stat_date",
        amount.alias("total"),
        F.when(is_new_visit(new_days), amount).otherwise(none).alias("new"),
        F.when(is_return_visit(), amount).otherwise(none).alias("returning"),
        F.when(is_old_customer(old_days), amount).otherwise(none).alias("old"),
    )


# --- metrics -------------------------------------------------------------------------------------


def member(amount: Column, count: Column) -> Column:
    return (amount > MEMBER_AMOUNT) | (count > MEMBER_PURCHASES)


def segment_metrics(events: DataFrame, visits: str, paid: str, unpaid: str) -> DataFrame:
    """Daily totals per shop. Followers and members come as event counts and as distinct users.

    The first aggregate is per (shop, day, user), so a hot shop is spread over its users; the second
    adds up one row per user.
    """
    is_member = member(F.col("total_purchase_amount"), F.col("total_purchase_count"))
    per_user = events.groupBy("shop_id", "stat_date", "user_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.sum("paid_count").alias("paid"),
        F.sum("unpaid_count").alias("unpaid"),
        F.sum("payment_amount").alias("amount"),
        F.sum(F.col("followed").cast("bigint")).alias("follow"),
        F.sum(is_member.cast("bigint")).alias("member"),
    )
    total = per_user.groupBy("shop_id", "stat_date").agg(
        F.sum("visits").alias(visits),
        F.sum("paid").alias(paid),
        F.sum("unpaid").alias(unpaid),
        F.sum("amount").cast("decimal(18,2)").alias("payment_amount"),
        F.sum("follow").alias("follow_count"),
        F.sum("member").alias("member_count"),
        F.sum((F.col("follow") > 0).cast("bigint")).alias("follow_users"),
        F.sum((F.col("member") > 0).cast("bigint")).alias("member_users"),
    )
    rate = F.when(F.col(visits) > 0, F.col(paid).cast("double") / F.col(visits)).otherwise(F.lit(0.0))
    price = F.when(
        F.col(paid) > 0, F.round(F.col("payment_amount") / F.col(paid).cast("decimal(18,0)"), 2)
    ).otherwise(F.lit(0)).cast("decimal(18,2)")
    return total.select(
        "shop_id",
        "stat_date",
        visits,
        paid,
        unpaid,
        rate.alias("payment_rate"),
        "payment_amount",
        price.alias("avg_price"),
        "follow_count",
        "member_count",
        "follow_users",
        "member_users",
    )


def new_visit_metrics(events: DataFrame) -> DataFrame:
    return segment_metrics(events, "visit_count", "paid_count", "unpaid_count")


def return_visit_metrics(events: DataFrame) -> DataFrame:
    return segment_metrics(events, "visit_count", "paid_count", "unpaid_count")


def old_customer_metrics(events: DataFrame) -> DataFrame:
    return segment_metrics(events, "revisit_count", "repurchase_count", "non_repurchase_count")


def shop_customer_day(cleaned: DataFrame) -> DataFrame:
    """Distinct customers per shop and day, counted in two steps so a hot shop spreads over users."""
    users = cleaned.select("shop_id", "stat_date", "user_id").distinct()
    return users.groupBy("shop_id", "stat_date").agg(F.count(F.lit(1)).alias("customer_count"))


def shop_sales_day(sales: DataFrame) -> DataFrame:
    """Daily sales per shop, in total and per segment, from :func:`segmented_sales`."""
    names = {"total": "total_sales", "new": "new_sales", "returning": "return_sales", "old": "old_sales"}
    return sales.groupBy("shop_id", "stat_date").agg(
        *[F.sum(c).cast("decimal(18,2)").alias(name) for c, name in names.items()]
    )


def segment_payment_ratio(daily: DataFrame) -> DataFrame:
    """Share of each segment in the sales of the shop and day, from :func:`shop_sales_day`."""
    def share(segment: str) -> Column:
        return F.when(
            F.col("total_sales") > 0,
            F.round(F.col(segment).cast("double") / F.col("total_sales").cast("double"), 6),
        ).otherwise(F.lit(0.0))

    return daily.select(
        "shop_id",
        "stat_date",
        share("new_sales").alias("new_ratio"),
        share("return_sales").alias("return_ratio"),
        share("old_sales").alias("old_ratio"),
    )
