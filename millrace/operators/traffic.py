"""Visitor flags and windowed traffic summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions import texts, times
from millrace.operators import logs
from millrace.operators.running import first_per_key

TRAFFIC_KEYS = ["vc", "ch", "ar", "is_new"]

# Days without a login after which a user counts as coming back.
BACK_AFTER_DAYS = 8


def _day(ts: str = "ts"):
    return F.to_date(F.col(ts))


def _opens_session():
    return F.coalesce(F.col("last_page_id"), F.lit("")) == ""


def uv_flag(views: DataFrame) -> DataFrame:
    """Mark the first view of each device and day, and views that open a session.

    The first view per (device, day) is an aggregate; the flag is found by meeting it on device, time and
    position, so no task ever holds all views of a device, and positions need not be unique beyond it.
    """
    first = first_per_key(views.withColumn("day", _day()), ["mid", "day"], ["ts", "seq"], ["ts", "seq"]).select(
        F.col("mid").alias("__mid"), F.col("ts").alias("__ts"), F.col("seq").alias("__seq")
    )
    met = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("mid", "ts", "seq")]
    return views.join(first, met, "left").select(
        *views.columns,
        F.col("__seq").isNotNull().cast("bigint").alias("uv_ct"),
        _opens_session().cast("bigint").alias("sv_ct"),
    )


def traffic_page_view_window(views: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Views, sessions, time spent and unique visitors per window, version, channel, area, newcomer.

    Every view counts once as a view; the first view per (device, day), found by an aggregate, counts
    once more as a visitor. Both kinds of rows have the same shape and go through one aggregate that
    combines before its shuffle, so no key is ever gathered in one task.
    """
    cell = [F.window("ts", width).alias("window"), *TRAFFIC_KEYS]
    none = F.lit(0).cast("bigint")
    once = F.lit(1).cast("bigint")
    counts = views.select(
        *cell,
        none.alias("uv_ct"),
        _opens_session().cast("bigint").alias("sv_ct"),
        once.alias("pv_ct"),
        F.col("during_time").alias("dur_sum"),
    )
    first = first_per_key(
        views.withColumn("day", _day()), ["mid", "day"], ["ts", "seq"], ["ts", *TRAFFIC_KEYS]
    )
    visitors = first.select(
        *cell, once.alias("uv_ct"), none.alias("sv_ct"), none.alias("pv_ct"), none.alias("dur_sum")
    )
    measures = ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]
    total = counts.unionByName(visitors).groupBy("window", *TRAFFIC_KEYS).agg(
        *[F.sum(c).alias(c) for c in measures]
    )
    return total.select(*times.window_bounds(F.col("window")), *TRAFFIC_KEYS, *measures)


def home_detail_uv_window(views: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Unique home and detail page visitors of the day, counted in the window of their first view."""
    first = (
        logs.home_or_detail(views)
        .groupBy("mid", "page_id", _day().alias("day"))
        .agg(F.min("ts").alias("ts"))
    )
    is_home = (F.col("page_id") == "home").cast("bigint")
    windowed = first.groupBy(F.window("ts", width)).agg(
        F.sum(is_home).alias("home_uv_ct"), F.sum(1 - is_home).alias("good_detail_uv_ct")
    )
    return windowed.select(
        *times.window_bounds(F.col("window")), "home_uv_ct", "good_detail_uv_ct"
    )


def first_per_day(df: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """Time of the first row of each key and day."""
    return df.groupBy(key, _day(ts).alias("day")).agg(F.min(ts).alias("ts"))


def cart_uu_window(cart_adds: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Users adding to the cart for the first time of the day, per window."""
    windowed = (
        first_per_day(cart_adds, "user_id")
        .groupBy(F.window("ts", width))
        .agg(F.count(F.lit(1)).alias("cart_add_uu_ct"))
    )
    return windowed.select(*times.window_bounds(F.col("window")), "cart_add_uu_ct")


def user_login_window(views: DataFrame, width: str = "1 second", back_after: int = BACK_AFTER_DAYS) -> DataFrame:
    """Unique users of the day and users coming back after a pause, per window of their first login.

    After the aggregate a user has at most one row per day, so the window that looks at the day
    before it is bounded by the number of days.
    """
    days = first_per_day(logs.logins(views), "uid")
    by_day = Window.partitionBy("uid").orderBy("day")
    pause = F.datediff(F.col("day"), F.lag("day").over(by_day))
    flagged = days.withColumn("back", F.coalesce((pause >= back_after).cast("bigint"), F.lit(0)))
    windowed = flagged.groupBy(F.window("ts", width)).agg(
        F.sum("back").alias("back_ct"), F.count(F.lit(1)).alias("uu_ct")
    )
    return windowed.select(*times.window_bounds(F.col("window")), "back_ct", "uu_ct")


def keyword_tokens(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per word of a text column."""
    return df.select(*keep, F.explode(texts.words(F.col(text))).alias("keyword"))


def keyword_window(views: DataFrame, width: str = "10 seconds") -> DataFrame:
    """How often each searched word occurs per window."""
    tokens = keyword_tokens(logs.keyword_searches(views), "item", ["ts"])
    windowed = tokens.groupBy(F.window("ts", width), "keyword").agg(
        F.count(F.lit(1)).alias("keyword_count")
    )
    return windowed.select(
        *times.window_bounds(F.col("window"), times.DAY_STAMP), "keyword", "keyword_count"
    )
