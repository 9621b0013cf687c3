"""Typed records out of the changelog, one projection per source table.

The fact and label operators take these columns. Amounts become ``decimal(16,2)``; a value that does
not parse becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import times
from millrace.operators import cdc
from millrace.operators.facts import PAYMENT_DONE, REFUND_DONE, REFUNDED, REFUNDING

IMAGE = "__image"


def _image(changes: DataFrame) -> DataFrame:
    """Changes with the row they are about: the new one, the old one where there is no new one."""
    return changes.withColumn(IMAGE, F.coalesce(F.col("after"), F.col("before")))


def _text(field: str, name: str | None = None) -> Column:
    return F.col(IMAGE)[field].alias(name or field)


def _as(field: str, kind: str, name: str | None = None) -> Column:
    return F.col(IMAGE)[field].try_cast(kind).alias(name or field)


def _money(field: str) -> Column:
    return _as(field, "decimal(16,2)")


def _time(field: str, name: str) -> Column:
    return times.millis_to_timestamp(F.col(IMAGE)[field].try_cast("bigint")).alias(name)


def _changed() -> Column:
    return times.millis_to_timestamp(F.col("ts_ms")).alias("ts")


def order_detail_records(changes: DataFrame) -> DataFrame:
    """Order details; the original amount is quantity times price."""
    price, count = F.col(IMAGE)["order_price"], F.col(IMAGE)["sku_num"]
    original = count.try_cast("decimal(16,2)") * price.try_cast("decimal(16,2)")
    return _image(cdc.of_table(changes, "order_detail")).select(
        _text("id"),
        _text("order_id"),
        _text("sku_id"),
        _text("sku_name"),
        _time("create_time", "create_ts"),
        _text("source_id"),
        _text("source_type"),
        _as("sku_num", "bigint"),
        _money("order_price"),
        original.cast("decimal(16,2)").alias("split_original_amount"),
        _money("split_activity_amount"),
        _money("split_coupon_amount"),
        _money("split_total_amount"),
        _changed(),
    )


def order_records(changes: DataFrame) -> DataFrame:
    return _image(cdc.of_table(changes, "order_info")).select(
        "op",
        _text("id"),
        _text("user_id"),
        _text("province_id"),
        _text("consignee"),
        _text("order_status", "status"),
        _money("original_total_amount"),
        _money("total_amount"),
        _time("create_time", "create_ts"),
        _changed(),
    )


def activity_records(changes: DataFrame) -> DataFrame:
    return _image(cdc.of_table(changes, "order_detail_activity")).select(
        _text("order_detail_id"), _text("activity_id"), _text("activity_rule_id"), _changed()
    )


def coupon_records(changes: DataFrame) -> DataFrame:
    return _image(cdc.of_table(changes, "order_detail_coupon")).select(
        _text("order_detail_id"), _text("coupon_id"), _changed()
    )


def payment_records(changes: DataFrame) -> DataFrame:
    """Payments that went through."""
    done = cdc.of_table(changes, "payment_info").where(
        (F.col("op") == "u") & (F.col("after")["payment_status"] == PAYMENT_DONE)
    )
    return _image(done).select(
        _text("user_id"), _text("order_id"), _text("payment_type"), _time("callback_time", "callback_ts"), _changed()
    )


def refund_payment_records(changes: DataFrame) -> DataFrame:
    """Refunds whose money was paid back."""
    done = cdc.status_became(changes, "refund_payment", "refund_status", PAYMENT_DONE)
    return _image(done).select(
        _text("id"), _text("order_id"), _text("sku_id"), _text("payment_type"), _money("total_amount"), _time("callback_time", "ts")
    )


def refund_request_records(changes: DataFrame, granted_only: bool = False) -> DataFrame:
    """Refund requests: all of them, or those that were granted."""
    requests = (
        cdc.status_became(changes, "order_refund_info", "refund_status", REFUND_DONE)
        if granted_only
        else cdc.of_table(changes, "order_refund_info")
    )
    return _image(requests).select(
        _text("id"),
        _text("user_id"),
        _text("order_id"),
        _text("sku_id"),
        _text("refund_type"),
        _as("refund_num", "bigint"),
        _money("refund_amount"),
        _text("refund_reason_type"),
        _text("refund_reason_txt"),
        _time("create_time", "ts"),
    )


def refunding_orders(changes: DataFrame) -> DataFrame:
    """Orders whose refund was asked for."""
    return order_records(cdc.status_became(changes, "order_info", "order_status", REFUNDING))


def refunded_orders(changes: DataFrame) -> DataFrame:
    """Orders whose refund is complete."""
    return order_records(cdc.status_became(changes, "order_info", "order_status", REFUNDED))


def comment_records(changes: DataFrame) -> DataFrame:
    """Comments with where they come from."""
    return _image(cdc.of_table(changes, "comment_info")).select(
        _text("id"),
        _text("user_id"),
        _text("sku_id"),
        _text("spu_id"),
        _text("order_id"),
        _text("appraise"),
        _text("comment_txt", "msg"),
        _text("nick_name"),
        F.col("source")["db"].alias("db_name"),
        F.col("source")["table"].alias("table_name"),
        F.col("source")["server_id"].alias("server_id"),
        "op",
        _time("create_time", "create_ts"),
        _changed(),
    )


def user_records(changes: DataFrame) -> DataFrame:
    """Users; the birthday is a number of days since 1970-01-01."""
    return _image(cdc.of_table(changes, "user_info")).select(
        _text("id", "uid"),
        _text("name", "uname"),
        _text("user_level"),
        _text("login_name"),
        _text("phone_num"),
        _text("email"),
        F.coalesce(F.col(IMAGE)["gender"], F.lit("home")).alias("gender"),
        _as("birthday", "int"),
        _changed(),
    ).where(F.coalesce(F.col("uid"), F.lit("")) != "")


def supplement_records(changes: DataFrame) -> DataFrame:
    """Body measures of users."""
    return _image(cdc.of_table(changes, "user_info_sup_msg")).select(
        _text("uid"),
        _text("height"),
        _text("unit_height"),
        _text("weight"),
        _text("unit_weight"),
        _time("create_ts", "create_ts"),
        _changed(),
    ).where(F.coalesce(F.col("uid"), F.lit("")) != "")
