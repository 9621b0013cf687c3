"""Page log: parsing, splitting, repair of the newcomer mark, device and search projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import times
from millrace.operators.joins import spread_lookup
from millrace.operators.running import first_per_key

CORRUPT = "_corrupt_record"


def parse_json(raw: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse a JSON text column; ``record`` is null and ``dirty`` true where it is not valid."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(column), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    # The generator keeps later filters above the parse, so each text is parsed once.
    with_record = raw.select("*", F.explode(F.array(parsed)).alias("__parsed"))
    dirty = F.col(f"__parsed.{CORRUPT}").isNotNull() | F.col("__parsed").isNull()
    record = F.struct(*[F.col(f"__parsed.{f.name}").alias(f.name) for f in schema.fields])
    return with_record.select(
        *raw.columns, dirty.alias("dirty"), F.when(~dirty, record).alias("record")
    )


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("dirty")).select("record.*")


def dirty_records(parsed: DataFrame, column: str = "value") -> DataFrame:
    return parsed.where(F.col("dirty")).select(column)


def drop_null_messages(raw: DataFrame, column: str = "value") -> DataFrame:
    return raw.where(F.col(column).isNotNull())


# --- split ---------------------------------------------------------------------------------------


def split_err(log: DataFrame) -> DataFrame:
    """The error of each record that has one, whatever else the record is."""
    return log.where(F.col("err").isNotNull()).select("seq", "err.*")


def split_start(log: DataFrame) -> DataFrame:
    """Start records, without their error."""
    return log.where(F.col("start").isNotNull()).drop("err")


def _not_start(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNull())


def split_display(log: DataFrame) -> DataFrame:
    """One row per displayed item, with the common part, the page and the record's time."""
    return _not_start(log).select(
        "seq", "common", "page", F.explode("displays").alias("display"), "ts"
    )


def split_action(log: DataFrame) -> DataFrame:
    """One row per action, with the common part and the page; the record's time is not attached."""
    return _not_start(log).select("seq", "common", "page", F.explode("actions").alias("action"))


def split_page(log: DataFrame) -> DataFrame:
    """Page records without error, displays and actions."""
    return _not_start(log).drop("err", "displays", "actions", "start")


# --- projections ---------------------------------------------------------------------------------


def page_views(log: DataFrame) -> DataFrame:
    """Flat page view rows: the typed columns the traffic operators work on."""
    return split_page(log).select(
        "seq",
        "common.*",
        "page.*",
        times.millis_to_timestamp(F.col("ts")).alias("ts"),
    )


def home_or_detail(views: DataFrame) -> DataFrame:
    return views.where(F.col("page_id").isin("home", "good_detail"))


def logins(views: DataFrame) -> DataFrame:
    """Views of known users that come from the login page or open a visit."""
    last = F.coalesce(F.col("last_page_id"), F.lit(""))
    return views.where((F.coalesce(F.col("uid"), F.lit("")) != "") & last.isin("login", ""))


def keyword_searches(views: DataFrame) -> DataFrame:
    return views.where(
        (F.col("last_page_id") == "search")
        & (F.col("item_type") == "keyword")
        & F.col("item").isNotNull()
    )


def device_search_base(log: DataFrame) -> DataFrame:
    """Device part of each record and the phrase searched for.

    The session, device id and newcomer mark are left out, the operating system is cut to its first
    word, an unknown user becomes "-1"; users with an empty id are dropped.
    """
    device = F.col("common").dropFields("sid", "mid", "is_new", "uid")
    device = device.withField("os", F.split(F.col("common.os"), " ")[0])
    searched = F.when(F.col("page.item_type") == "keyword", F.col("page.item"))
    return log.select(
        "seq",
        F.coalesce(F.col("common.uid"), F.lit("-1")).alias("uid"),
        times.millis_to_timestamp(F.col("ts")).alias("ts"),
        device.alias("device"),
        searched.alias("search_item"),
    ).where(F.col("uid") != "")


# --- newcomer mark -------------------------------------------------------------------------------


def repaired_is_new(is_new: Column, day: Column, first_is_new: Column, first_day: Column) -> Column:
    """"1" stays only on the day the device was first seen, and never if it was first seen as old."""
    known_since = F.when(first_is_new == "1", first_day).otherwise(F.date_sub(first_day, 1))
    return F.when((is_new == "1") & (known_since != day), "0").otherwise(is_new)


def fix_is_new(log: DataFrame) -> DataFrame:
    """Correct ``common.is_new`` from the first record of each device.

    Only the first record of a device decides, so the state is one aggregate row per device; records
    meet it in a join that splits heavy devices. The mark is kept for good, where a short expiry
    would forget devices within seconds.
    """
    seen = log.select(
        F.col("common.mid").alias("__mid"),
        F.to_date(times.millis_to_timestamp(F.col("ts"))).alias("first_day"),
        F.col("common.is_new").alias("first_is_new"),
        "ts",
        "seq",
    )
    first = first_per_key(seen, ["__mid"], ["ts", "seq"], ["first_day", "first_is_new"])
    keyed = log.withColumn("__mid", F.col("common.mid"))
    joined = spread_lookup(
        keyed, first, {"__mid": "__mid"}, {"first_day": "first_day", "first_is_new": "first_is_new"}
    )
    fixed = repaired_is_new(
        F.col("common.is_new"),
        F.to_date(times.millis_to_timestamp(F.col("ts"))),
        F.col("first_is_new"),
        F.col("first_day"),
    )
    return joined.withColumn("common", F.col("common").withField("is_new", fixed)).select(*log.columns)


# --- rows as JSON --------------------------------------------------------------------------------


def _snake(name: str) -> str:
    out = "".join("_" + c.lower() if c.isupper() else c for c in name)
    return out.lstrip("_")


def rows_to_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Each row as one JSON text with snake_case field names."""
    fields = [F.col(c).alias(_snake(c)) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias(column))
