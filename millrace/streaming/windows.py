"""Windows over first visits of the day, as single streams: a keyed state in front, a window behind it.

The watermark of the source goes through the state, so a window is emitted once, when nothing that belongs to it can
come any more.
"""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from millrace.functions import times
from millrace.operators import logs
from millrace.operators.traffic import BACK_AFTER_DAYS

# How many days a key's days are remembered behind its newest one; rows that come later than that are gone already,
# as sources are late by seconds.
KEPT_DAYS = 1


class FirstOfDays(StatefulProcessor):
    """The first row of each day of a key, with the days since the key's day before (null for its first one).

    Days are kept one by one, so a row of yesterday that comes after midnight doesn't open yesterday again. The day
    before the kept ones stays, as the next pause is counted from it.
    """

    def __init__(self, keys: list[T.StructField]):
        self.keys = keys
        self.output = T.StructType([*keys, T.StructField("ts", T.TimestampType()), T.StructField("pause", T.LongType())])

    def init(self, handle):
        self.days = handle.getListState("days", "day string")

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)
        if not frames:
            return
        known = [d for (d,) in self.days.get()] if self.days.exists() else []
        out = []
        for ts in pd.concat([f["ts"] for f in frames]).sort_values():
            day = str(ts.date())
            if day in known:
                continue
            before = max((d for d in known if d < day), default=None)
            out.append((*key, ts, None if before is None else (ts.date() - pd.Timestamp(before).date()).days))
            known.append(day)
        if out:
            kept = sorted(known)
            last = str((pd.Timestamp(kept[-1]) - timedelta(days=KEPT_DAYS)).date())
            older = [d for d in kept if d < last]
            self.days.put([(d,) for d in [*older[-1:], *[d for d in kept if d >= last]]])
            frame = pd.DataFrame(out, columns=self.output.names)
            yield frame.assign(ts=pd.to_datetime(frame["ts"]), pause=frame["pause"].astype("Int64"))

    def close(self) -> None:
        pass


def first_of_days(df: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """(keys, ts, pause) of the first row of each key and day; ``df`` has the keys and ``ts``."""
    processor = FirstOfDays([df.schema[k] for k in keys])
    rows = df.select(*keys, "ts").where(F.col("ts").isNotNull()).dropna(subset=keys).withWatermark("ts", delay)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Append", timeMode="EventTime", eventTimeColumnName="ts",
    )


def _windowed(first: DataFrame, width: str, **counts: Column) -> DataFrame:
    total = first.groupBy(F.window("ts", width)).agg(*[c.alias(n) for n, c in counts.items()])
    return total.select(*times.window_bounds(F.col("window")), *counts)


def home_detail_uv_window(views: DataFrame, delay: str, width: str = "5 seconds") -> DataFrame:
    """Stream form of :func:`millrace.operators.traffic.home_detail_uv_window`."""
    first = first_of_days(logs.home_or_detail(views), ["mid", "page_id"], delay)
    home = (F.col("page_id") == "home").cast("bigint")
    return _windowed(first, width, home_uv_ct=F.sum(home), good_detail_uv_ct=F.sum(1 - home))


def cart_uu_window(cart_adds: DataFrame, delay: str, width: str = "5 seconds") -> DataFrame:
    """Stream form of :func:`millrace.operators.traffic.cart_uu_window`."""
    return _windowed(first_of_days(cart_adds, ["user_id"], delay), width, cart_add_uu_ct=F.count(F.lit(1)))


def user_login_window(views: DataFrame, delay: str, width: str = "1 second", back_after: int = BACK_AFTER_DAYS) -> DataFrame:
    """Stream form of :func:`millrace.operators.traffic.user_login_window`."""
    first = first_of_days(logs.logins(views), ["uid"], delay)
    back = F.coalesce((F.col("pause") >= back_after).cast("bigint"), F.lit(0))
    return _windowed(first, width, back_ct=F.sum(back), uu_ct=F.count(F.lit(1)))
