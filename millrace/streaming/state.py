"""Keyed state for streams. Each processor gives the rows its batch operator gives.

Within a micro-batch the rows of a key are put in event order first; across batches arrival order
counts. Rows of a key come in Arrow batches, so a processor never holds more than one key's new rows.
State expires by ``ttl_ms`` where one is given, which needs processing-time mode.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.customers import FOLLOW, PAYMENT
from millrace.operators.traffic import BACK_AFTER_DAYS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


class _KeyedProcessor(StatefulProcessor):
    """One value state; subclasses turn (state, ordered rows) into (state, output rows)."""

    state_schema: T.StructType
    order: list[str] = ["ts", "seq"]

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        if not frames:
            return
        ordered = pd.concat(frames).sort_values(self.order, kind="stable").reset_index(drop=True)
        before = self.state.get() if self.state.exists() else None
        after, out = self.step(before, ordered)
        if after is not None and after != before:
            self.state.update(after)
        if len(out):
            yield out

    def close(self) -> None:
        pass

    def step(self, state: tuple | None, rows: pd.DataFrame) -> tuple[tuple | None, pd.DataFrame]:
        raise NotImplementedError


class Newcomer(_KeyedProcessor):
    """Repair of the newcomer mark; rows have mid, is_new, ts, seq."""

    state_schema = _struct(known_since=T.StringType())

    def step(self, state, rows):
        days = rows["ts"].dt.date
        if state is None:
            first = days.iloc[0] - timedelta(days=0 if rows["is_new"].iloc[0] == "1" else 1)
            state = (str(first),)
        stale = (rows["is_new"] == "1") & (days.astype(str) != state[0])
        return state, rows.assign(is_new=rows["is_new"].mask(stale, "0"))


class FirstOfDay(_KeyedProcessor):
    """Flag the first row of each key and day; rows have ts, seq and get uv_ct."""

    state_schema = _struct(day=T.StringType())

    def step(self, state, rows):
        days = rows["ts"].dt.date.astype(str)
        first = ~days.duplicated() & (days != (state[0] if state else ""))
        return (max(days.iloc[-1], state[0] if state else ""),), rows.assign(uv_ct=first.astype("int64"))


class Login(_KeyedProcessor):
    """First login of each day, with the mark of users who come back; rows have uid, ts."""

    state_schema = _struct(day=T.StringType())
    order = ["ts"]

    def step(self, state, rows):
        last = date.fromisoformat(state[0]) if state else None
        out = []
        for ts in rows["ts"]:
            day = ts.date()
            if last is not None and day <= last:
                continue
            back = last is not None and (day - last).days >= BACK_AFTER_DAYS
            out.append((rows["uid"].iloc[0], ts, int(back), 1))
            last = day
        return (str(last),), pd.DataFrame(out, columns=["uid", "ts", "back_ct", "uu_ct"])


class Retract(_KeyedProcessor):
    """Rows with a sign; a repeated key first takes back its previous row."""

    def __init__(self, schema: T.StructType, amounts: list[str], order: list[str], ttl_ms: int | None = None):
        super().__init__(ttl_ms)
        self.state_schema = schema
        self.amounts = amounts
        self.order = order
        self.names = schema.names

    def step(self, state, rows):
        previous = pd.DataFrame([state] if state else [], columns=self.names)
        taken_back = pd.concat([previous, rows.iloc[:-1][self.names]], ignore_index=True)
        for amount in self.amounts:
            taken_back[amount] = [None if v is None else -v for v in taken_back[amount]]
        out = pd.concat([taken_back.assign(sign=-1), rows[self.names].assign(sign=1)], ignore_index=True)
        last = rows.iloc[-1]
        return tuple(_plain(last[n]) for n in self.names), out


class NewestOnly(_KeyedProcessor):
    """Rows whose version exceeds all earlier ones of the key."""

    state_schema = _struct(best=T.LongType())

    def __init__(self, version: str, order: list[str], ttl_ms: int | None = None):
        super().__init__(ttl_ms)
        self.version = version
        self.order = order

    def step(self, state, rows):
        versions = rows[self.version]
        best_before = versions.cummax().shift(1)
        if state is not None:
            best_before = best_before.fillna(state[0]).clip(lower=state[0])
        newest = best_before.isna() | (versions > best_before)
        top = int(versions.max())
        return (top if state is None else max(top, state[0]),), rows[newest]


class CustomerHistory(_KeyedProcessor):
    """What is known of (shop, user) before each action and the totals through it.

    Output columns are those of the batch history, so the same segment conditions apply.
    """

    state_schema = _struct(
        purchases=T.LongType(),
        amount=T.DecimalType(16, 2),
        last_ts=T.TimestampType(),
        last_purchase=T.TimestampType(),
        followed=T.IntegerType(),
    )

    def step(self, state, rows):
        purchases, amount, last_ts, last_purchase, followed = state or (0, Decimal(0), None, None, 0)
        history = []
        for ts, kind, value in zip(rows["ts"], rows["action_type"], rows["amount"]):
            known = (purchases, last_ts, last_purchase)
            if kind == FOLLOW:
                followed = 1
            if kind == PAYMENT:
                purchases += 1
                amount += value
                last_purchase = ts.to_pydatetime()
            last_ts = ts.to_pydatetime()
            history.append((*known, followed, purchases, amount))
        names = [
            "__prior_purchases",
            "__last_ts",
            "__last_purchase",
            "__followed",
            "total_purchase_count",
            "total_purchase_amount",
        ]
        out = pd.concat([rows, pd.DataFrame(history, columns=names)], axis=1)
        for c in ("__last_ts", "__last_purchase"):
            out[c] = pd.to_datetime(out[c])
        return (purchases, amount, last_ts, last_purchase, followed), out


class DeviceRollup(_KeyedProcessor):
    """Views so far and the different devices, channels and phrases seen so far, per row."""

    FIELDS = ("os", "ch", "md", "ba", "search_item")
    state_schema = T.StructType(
        [T.StructField("pv", T.LongType())] + [T.StructField(f, T.ArrayType(T.StringType())) for f in FIELDS]
    )

    def step(self, state, rows):
        pv = state[0] if state else 0
        seen = {f: set(state[n + 1]) if state else set() for n, f in enumerate(self.FIELDS)}
        out = []
        for row in rows.itertuples(index=False):
            pv += 1
            for f in self.FIELDS:
                value = getattr(row, f)
                if value is not None and not pd.isna(value):
                    seen[f].add(value)
            out.append((row.uid, pv, *[",".join(sorted(seen[f])) for f in self.FIELDS], row.ts, row.seq))
        frame = pd.DataFrame(out, columns=["uid", "pv", *self.FIELDS, "ts", "seq"])
        return (pv, *[sorted(seen[f]) for f in self.FIELDS]), frame


def _plain(value):
    """A pandas cell as the plain value a state row takes."""
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def apply_state(df: DataFrame, key: list[str], processor: StatefulProcessor, schema: T.StructType | str, time_mode: str = "None") -> DataFrame:
    """Run a processor over a keyed stream, in append mode."""
    return df.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode=time_mode,
    )


def newcomer(df: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    return apply_state(df, ["mid"], Newcomer(ttl_ms), df.schema, "ProcessingTime" if ttl_ms else "None")


def first_of_day(df: DataFrame, key: str) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("uv_ct", T.LongType())])
    return apply_state(df, [key], FirstOfDay(), schema)


def login(df: DataFrame) -> DataFrame:
    return apply_state(
        df.select("uid", "ts"), ["uid"], Login(), "uid string, ts timestamp, back_ct bigint, uu_ct bigint"
    )


def retract(df: DataFrame, key: str, order: list[str], amounts: list[str]) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("sign", T.IntegerType())])
    return apply_state(df, [key], Retract(df.schema, amounts, order), schema)


def newest_only(df: DataFrame, key: str, version: str, arrival: list[str]) -> DataFrame:
    return apply_state(df, [key], NewestOnly(version, arrival), df.schema)


def customer_history(cleaned: DataFrame) -> DataFrame:
    added = _struct(
        __prior_purchases=T.LongType(),
        __last_ts=T.TimestampType(),
        __last_purchase=T.TimestampType(),
        __followed=T.IntegerType(),
        total_purchase_count=T.LongType(),
        total_purchase_amount=T.DecimalType(16, 2),
    )
    schema = T.StructType([*cleaned.schema.fields, *added.fields])
    return apply_state(cleaned, ["shop_id", "user_id"], CustomerHistory(), schema)


def device_rollup(df: DataFrame) -> DataFrame:
    schema = "uid string, pv bigint, os string, ch string, md string, ba string, search_item string, ts timestamp, seq bigint"
    return apply_state(df, ["uid"], DeviceRollup(), schema)
