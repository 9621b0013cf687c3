"""Dates, windows and time slots."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND_TEXT = "yyyy-MM-dd HH:mm:ss"
DAY_TEXT = "yyyy-MM-dd"
DAY_STAMP = "yyyyMMdd"

# Epoch numbers below this are seconds, the others are milliseconds.
SECONDS_BELOW = 10_000_000_000

# Slot name and the first hour that no longer belongs to it.
TIME_SLOTS = [
    ("凌晨", 6),
    ("早晨", 9),
    ("上午", 12),
    ("中午", 14),
    ("下午", 18),
    ("晚上", 22),
    ("夜间", 24),
]


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_TEXT)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, DAY_TEXT)


def day_stamp(ts: Column) -> Column:
    return F.date_format(ts, DAY_STAMP)


def window_bounds(window: Column, cur_date_format: str = DAY_TEXT) -> list[Column]:
    """stt, edt and cur_date of a tumbling window."""
    return [
        second_text(window["start"]).alias("stt"),
        second_text(window["end"]).alias("edt"),
        F.date_format(window["start"], cur_date_format).alias("cur_date"),
    ]


def epoch_millis(value: Column) -> Column:
    """Epoch number in seconds or milliseconds, as milliseconds; null when it is no number."""
    number = value.try_cast("bigint")
    return F.when(number < SECONDS_BELOW, number * 1000).otherwise(number)


def time_slot(ts: Column) -> Column:
    """Name of the slot of the day a timestamp falls in."""
    hour = F.hour(ts)
    slot = None
    for name, upper in TIME_SLOTS:
        slot = F.when(hour < upper, name) if slot is None else slot.when(hour < upper, name)
    return slot


def seconds_slice(ts: Column, width: int) -> Column:
    """Number of the fixed-width stretch of time a timestamp lies in."""
    return F.floor(F.unix_seconds(ts) / F.lit(width)).cast("bigint")
