"""User labels: profile, six scores per age bucket, their sum and the nested label."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import profile, times
from millrace.operators.joins import enrich, interval_join, measured_lookups, spread_lookup
from millrace.operators.running import Running, running

Numbers = tuple[float, ...]

BUCKETS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Weight of each feature.
WEIGHTS = {
    "device": Decimal("0.1"),
    "search": Decimal("0.15"),
    "time": Decimal("0.1"),
    "amount": Decimal("0.15"),
    "brand": Decimal("0.2"),
    "category": Decimal("0.3"),
}

# Six numbers per label, in the order of the buckets.
DEVICE = {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
SEARCH = {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
}
SEARCH_OTHER = (0, 0, 0, 0, 0, 0)
TIME = {
    "凌晨": (0.2, 0.1, 0.1, 0.1, 0.1, 0.1),
    "早晨": (0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
    "上午": (0.2, 0.2, 0.2, 0.2, 0.3, 0.4),
    "中午": (0.4, 0.4, 0.4, 0.4, 0.4, 0.3),
    "下午": (0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
    "晚上": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "夜间": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}
AMOUNT = {
    "低消费": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "中消费": (0.2, 0.4, 0.6, 0.7, 0.8, 0.7),
    "高消费": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),
}
AMOUNT_MIDDLE_FROM, AMOUNT_HIGH_FROM = 1000, 4000
BRAND = {
    "A": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "B": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "C": (0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
    "D": (0.3, 0.4, 0.6, 0.8, 0.9, 0.2),
}
BRAND_OTHER = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
# Members of each group.
BRAND_GROUPS = {
    "A": ["TCL"],
    "B": ["苹果", "联想", "小米"],
    "C": ["欧莱雅"],
    "D": ["香奈儿"],
}
CATEGORY = {
    "1": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "2": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
}
CATEGORY_OTHER = (0.1, 0.2, 0.4, 0.5, 0.8, 0.9)
# Members of each group.
CATEGORY_GROUPS = {
    "1": ["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"],
    "2": ["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"],
}

SCORE_TYPE = "decimal(6,3)"


def _scored(df: DataFrame, prefix: str, label: Column, table: Mapping[str, Numbers], weight: Decimal, other: Numbers | None = None) -> DataFrame:
    """Add six columns: the label's numbers times the weight, half up to three digits.

    The products are constants, so scoring is one lookup per row in a projection. Labels that are
    null, or unknown where there is no ``other`` row, have no score.
    """
    def products(numbers: Numbers) -> Column:
        values = [(Decimal(str(n)) * weight).quantize(Decimal("0.001"), ROUND_HALF_UP) for n in numbers]
        return F.array(*[F.lit(v).cast(SCORE_TYPE) for v in values])

    by_label = F.create_map(*[c for name, numbers in table.items() for c in (F.lit(name), products(numbers))])
    numbers = F.try_element_at(by_label, label)
    if other is not None:
        numbers = F.when(label.isNotNull(), F.coalesce(numbers, products(other)))
    scores = [F.col("__numbers")[i].alias(f"{prefix}_{b}") for i, b in enumerate(BUCKETS)]
    return df.withColumn("__numbers", numbers).select(*df.columns, *scores)


def _group(value: Column, groups: Mapping[str, list[str]]) -> Column:
    """Group a value belongs to, "" for none, null for null and empty values."""
    by_member = F.create_map(*[F.lit(c) for name, members in groups.items() for m in members for c in (m, name)])
    return F.when(value.isNotNull() & (value != ""), F.coalesce(F.try_element_at(by_member, value), F.lit("")))


def score_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{b}" for b in BUCKETS]


# --- device and search ---------------------------------------------------------------------------


def user_device_rollup(base: DataFrame) -> DataFrame:
    """Views per user and the different devices, channels and phrases, as sorted comma lists.

    Rows first collapse to the different combinations per user, so the sets are built from those
    and not from every view of a hot user.
    """
    parts = {c: F.col(f"device.{c}") for c in ("os", "ch", "md", "ba")}
    combos = base.groupBy(
        "uid", *[v.alias(c) for c, v in parts.items()], "search_item"
    ).agg(F.count(F.lit(1)).alias("__n"), F.max("ts").alias("__ts"))
    return combos.groupBy("uid").agg(
        F.sum("__n").alias("pv"),
        *[
            F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c)
            for c in (*parts, "search_item")
        ],
        F.max("__ts").alias("ts"),
    )


def user_device_values(base: DataFrame) -> DataFrame:
    """Views per user and value of each field (os, ch, md, ba, search_item), one row each.

    The long form of :func:`user_device_rollup`: nothing is gathered, so a user with any number of different
    phrases is as many rows. Empty values have none.
    """
    parts = {c: F.col(f"device.{c}") for c in ("os", "ch", "md", "ba")} | {"search_item": F.col("search_item")}
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), value.alias("value")) for name, value in parts.items()]))
    long = base.select("uid", values.alias("__v")).select("uid", "__v.*").where(F.coalesce("value", F.lit("")) != "")
    return long.groupBy("uid", "field", "value").agg(F.count(F.lit(1)).alias("views"))


def user_device_latest_window(base: DataFrame, width: str = "2 minutes") -> DataFrame:
    """Last device row per user and window, with the user's views so far.

    Views are counted per window first; the running total then looks at one row per window, day by day, so a
    user's windows are never one task's.
    """
    latest = F.max_by(F.struct("device", "search_item", "ts"), F.struct("ts", "seq")).alias("__last")
    windowed = base.groupBy("uid", F.window("ts", width)).agg(
        latest, F.count(F.lit(1)).alias("__n")
    )
    counted = windowed.withColumn("__from", F.col("window.start"))
    day = F.floor(F.unix_seconds("__from") / 86_400)
    so_far = running(counted, ["uid"], ["__from"], day, [Running("__views", "sum", F.col("__n"), through=True)])
    return so_far.select(
        "uid",
        times.second_text(F.col("window.start")).alias("stt"),
        times.second_text(F.col("window.end")).alias("edt"),
        F.col("__views").alias("pv"),
        *[F.col(f"__last.device.{c}").alias(c) for c in ("os", "ch", "md", "ba")],
        F.col("__last.search_item").alias("search_item"),
        F.col("__last.ts").alias("ts"),
    )


DEVICE_FIELDS = ("os", "ch", "md", "ba", "search_item")


def user_device_running(base: DataFrame, slice_by: Column) -> DataFrame:
    """Per event the user's views so far and how many different values of each field were seen so far.

    ``base`` has uid, ts, seq (different for every event), device and search_item; null and empty values don't
    count. A value counts at the event that shows it first, which is an aggregate over (uid, field, value); the
    events' marks are then summed in order, by slices of time (``slice_by`` over ts). No set of values is built.
    """
    values = [F.struct(F.lit(n).alias("field"), (F.col("search_item") if n == "search_item" else F.col(f"device.{n}")).alias("value")) for n in DEVICE_FIELDS]
    long = base.select("uid", "ts", "seq", F.explode(F.array(*values)).alias("__v")).where(F.coalesce("__v.value", F.lit("")) != "")
    first = long.groupBy("uid", "__v").agg(F.min(F.struct("ts", "seq")).alias("__at"))
    marks = first.groupBy("uid", "__at").agg(
        *[F.sum((F.col("__v.field") == n).cast("bigint")).alias(f"__new_{n}") for n in DEVICE_FIELDS]
    )
    events = base.select("uid", "ts", "seq").withColumn("__at", F.struct("ts", "seq"))
    marked = events.join(marks, ["uid", "__at"], "left").drop("__at")
    measures = [Running("pv", "sum", F.lit(1).cast("bigint"), through=True)]
    measures += [Running(f"n_{n}", "sum", F.coalesce(f"__new_{n}", F.lit(0).cast("bigint")), through=True) for n in DEVICE_FIELDS]
    counted = running(marked, ["uid"], ["ts", "seq"], slice_by, measures)
    return counted.select("uid", "ts", "seq", *[m.name for m in measures])


def score_device(df: DataFrame, os: str = "os") -> DataFrame:
    """Device score from the first of the user's operating systems."""
    judged = df.withColumn("judge_os", F.split(F.col(os), ",")[0])
    return _scored(judged, "device", F.col("judge_os"), DEVICE, WEIGHTS["device"])


def score_search(df: DataFrame, categories: DataFrame, compare: DataFrame) -> DataFrame:
    """Search score: phrase to category, category to search category, search category to numbers.

    ``categories`` has ``b3name, b1name``; ``compare`` has ``category_name, search_category``; both
    have one row per key. Phrases without a search category score 0.
    """
    # Most views are no search and have no phrase: those rows are dealt apart.
    known = spread_lookup(df, categories, {"search_item": "b3name"}, {"b1name": "b1_category"})
    known = enrich(
        known, compare, {"b1_category": "category_name"}, {"search_category": "search_category"}
    )
    label = F.coalesce(F.col("search_category"), F.lit("unknown"))
    return _scored(known, "search", label, SEARCH, WEIGHTS["search"], SEARCH_OTHER)


# --- order ---------------------------------------------------------------------------------------


def pay_time_slot(df: DataFrame, ts: str = "create_ts") -> DataFrame:
    return df.withColumn("pay_time_slot", times.time_slot(F.col(ts)))


def score_time(df: DataFrame, slot: str = "pay_time_slot") -> DataFrame:
    return _scored(df, "time", F.col(slot), TIME, WEIGHTS["time"])


def spending_power(amount: Column) -> Column:
    low, middle, high = AMOUNT
    return (
        F.when(amount < AMOUNT_MIDDLE_FROM, low)
        .when(amount < AMOUNT_HIGH_FROM, middle)
        .when(amount.isNotNull(), high)
    )


def score_amount(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Amount score; exactly 1000 belongs to the middle band."""
    banded = df.withColumn("spending_pow", spending_power(F.col(amount)))
    return _scored(banded, "amount", F.col("spending_pow"), AMOUNT, WEIGHTS["amount"])


def score_brand(df: DataFrame, brand: str = "tname", groups: Mapping[str, list[str]] = BRAND_GROUPS) -> DataFrame:
    return _scored(df, "brand", _group(F.col(brand), groups), BRAND, WEIGHTS["brand"], BRAND_OTHER)


def score_category(df: DataFrame, category: str = "b1_name", groups: Mapping[str, list[str]] = CATEGORY_GROUPS) -> DataFrame:
    return _scored(df, "category", _group(F.col(category), groups), CATEGORY, WEIGHTS["category"], CATEGORY_OTHER)


def order_dimensions(details: DataFrame, snapshot: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Brand and top category of each ordered sku."""
    return measured_lookups(
        details,
        [
            (snapshot, {"sku_id": "skuid"}, {"c3id": "c3id", "tname": "tname"}),
            (hierarchy, {"c3id": "id"}, {"b1name": "b1_name"}),
        ],
    )


# --- profile and label ---------------------------------------------------------------------------


def user_profile(users: DataFrame, as_of: Column) -> DataFrame:
    """User rows with birthday as a date, age on ``as_of``, birth decade and zodiac sign."""
    birthday = F.date_from_unix_date(F.col("birthday"))
    return users.where(F.coalesce(F.col("uid"), F.lit("")) != "").select(
        "uid",
        "uname",
        "user_level",
        "login_name",
        "phone_num",
        "email",
        F.coalesce(F.col("gender"), F.lit("home")).alias("gender"),
        F.date_format(birthday, times.DAY_TEXT).alias("birthday"),
        profile.birth_decade(birthday).cast("bigint").alias("decade"),
        profile.whole_years(birthday, as_of).cast("bigint").alias("age"),
        profile.zodiac_sign(birthday).alias("zodiac_sign"),
        "ts",
    )


def user_profile_interval(users: DataFrame, supplements: DataFrame, lower: int = -300, upper: int = 300) -> DataFrame:
    """Users with the body measures reported within the interval."""
    extra = supplements.withColumnRenamed("ts", "sup_ts")
    return interval_join(users, extra, ["uid"], "ts", "sup_ts", lower, upper)


FEATURES = ["device", "search", "time", "amount", "brand", "category"]


def label_scores_join(
    devices: DataFrame, orders: DataFrame, lower: int = -6 * 3600, upper: int = 6 * 3600, join: Callable[..., DataFrame] = interval_join
) -> DataFrame:
    """Device and order scores of a user within the interval, and the sum per bucket.

    A feature without a score counts as 0. Streams give their own ``join``.
    """
    order = orders.withColumnRenamed("ts", "order_ts")
    joined = join(devices, order, ["uid"], "ts", "order_ts", lower, upper)
    sums = {
        f"sum_{b}": sum(
            (F.coalesce(F.col(f"{f}_{b}"), F.lit(0)) for f in FEATURES[1:]),
            F.coalesce(F.col(f"{FEATURES[0]}_{b}"), F.lit(0)),
        ).cast(SCORE_TYPE)
        for b in BUCKETS
    }
    return joined.withColumns(sums)


def label_max_bucket(df: DataFrame) -> DataFrame:
    """Bucket with the largest sum; ties go to the youngest."""
    ranked = F.array_max(
        F.array(
            *[
                F.struct(F.col(f"sum_{b}").alias("score"), F.lit(-i).alias("youth"), F.lit(b).alias("bucket"))
                for i, b in enumerate(BUCKETS)
            ]
        )
    )
    return df.withColumn("__best", ranked).select(
        *df.columns,
        F.col("__best.bucket").alias("best_bucket"),
        F.col("__best.score").alias("best_score"),
    )


def user_label(
    scores: DataFrame, profiles: DataFrame, lower: int = -6 * 3600, upper: int = 6 * 3600, join: Callable[..., DataFrame] = interval_join
) -> DataFrame:
    """Nested user label out of bucket scores and profile within the interval. Streams give their own ``join``."""
    base = profiles.withColumnRenamed("ts", "profile_ts")
    joined = label_max_bucket(join(scores, base, ["uid"], "ts", "profile_ts", lower, upper))
    return joined.select(
        "uid",
        "uname",
        F.col("ts").alias("ts"),
        times.day_stamp(F.col("ts")).alias("ds"),
        F.struct(
            "decade",
            "zodiac_sign",
            "gender",
            "login_name",
            "email",
            "phone_num",
            "height",
            "weight",
            "judge_os",
            "user_level",
            "birthday",
            F.col("age").alias("base_age"),
        ).alias("user_base_label"),
        F.struct(F.col("pv").alias("intraday_pv"), "search_item").alias("user_log_label"),
        F.struct("md", "ba", "os", "ch", F.col("pay_time_slot").alias("login_time_slot")).alias("user_device_label"),
        F.struct(
            F.struct(*[F.col(f"sum_{b}").alias(f"age_sum{b}") for b in BUCKETS]).alias("computer_age_info"),
            "spending_pow",
            F.struct("best_bucket", "best_score").alias("calculate_age"),
        ).alias("user_calculate_label"),
        F.struct("sku_name", "b1_name", "tname", "sku_id").alias("sup_info_message"),
    )


def merge_labels(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of both sides, with the day of the right side's time as ``ds`` where it has one.

    The right side wins where it has a value; a null on the right never removes a value.
    """
    if "ts" in right.columns and "ds" not in right.columns:
        right = right.withColumn("ds", times.day_stamp(F.col("ts")))
    both = [c for c in left.columns if c in right.columns and c != key]
    renamed = right.select(F.col(key), *[F.col(c).alias(f"__r_{c}") if c in both else F.col(c) for c in right.columns if c != key])
    joined = left.join(renamed, [key])
    return joined.select(
        key,
        *[F.coalesce(F.col(f"__r_{c}"), F.col(c)).alias(c) if c in both else F.col(c) for c in left.columns if c != key],
        *[c for c in right.columns if c not in left.columns],
    )
