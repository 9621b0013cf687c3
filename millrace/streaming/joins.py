"""Stream operators that keep rows and take results back: joins with retained state, quiet spells, window updates.

Each gives, batch by batch, the rows of its closed form in :mod:`millrace.operators`. Within a micro-batch the rows
of a key are taken in order of their position; across batches arrival order counts. State is kept per row in map
state, so an update rewrites one entry, and event-time timers remove what has outlived its span.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions import keys
from millrace.operators import changelog
from millrace.operators.labels import DEVICE_FIELDS
from millrace.operators.trade import SKU_AMOUNTS

AT = ["at_ts", "at_side", "at_seq"]
AT_FIELDS = [T.StructField("at_ts", T.TimestampType()), T.StructField("at_side", T.IntegerType()), T.StructField("at_seq", T.StringType())]


def _cell(value, kind: T.DataType):
    """A pandas cell as the plain value that a state row takes; numbers beside nulls come as floats."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return int(value)
    return value.item() if hasattr(value, "item") else value


def _frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=schema.names)
    for field in schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            frame[field.name] = pd.to_datetime(frame[field.name])
        elif isinstance(field.dataType, (T.LongType, T.IntegerType)):
            frame[field.name] = frame[field.name].astype("Int64")
    return frame


def _ordered(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame | None:
    frames = list(rows)
    return pd.concat(frames).sort_values(order, kind="stable") if frames else None


class JoinOverTime(StatefulProcessor):
    """One key of :func:`millrace.operators.changelog.join_over_time`.

    Rows of both sides come tagged: ``sign`` is 1 or -1 for rows of the left changelog and 0 for upserts of the
    right. State: the left rows that are still joined, each with what it shows, and the right row that is current.
    """

    def __init__(self, left: list[T.StructField], right: list[T.StructField], life: int, inner: bool):
        self.left_fields, self.right_fields = left, right
        self.life, self.inner = timedelta(seconds=life), inner
        self.output = T.StructType([*left, *right, *AT_FIELDS, T.StructField("sign", T.IntegerType()), T.StructField("origin", T.StringType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        seen = [T.StructField("born_ts", T.TimestampType()), T.StructField("seen", T.StringType())]
        self.handle = handle
        self.left = handle.getMapState(
            "left", T.StructType([T.StructField("origin", T.StringType())]), T.StructType([*self.left_fields, *self.right_fields, *seen])
        )
        self.right = handle.getValueState("right", T.StructType([*self.right_fields, *seen]))

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, [*AT, "sign"])
        if frame is None:
            return
        names, out = list(frame.columns), []
        l_at = [(names.index(f.name), f.dataType) for f in self.left_fields]
        r_at = [(names.index(f.name), f.dataType) for f in self.right_fields]
        p_at = [names.index(n) for n in (*AT, "sign", "origin")]
        nothing = (None,) * len(r_at)
        for row in frame.itertuples(index=False, name=None):
            ts, side, seq, sign, origin = (row[i] for i in p_at)
            ts = ts.to_pydatetime()
            at = (ts, int(side), seq)
            if sign == 0:
                value = tuple(_cell(row[i], kind) for i, kind in r_at)
                name = f"{ts.isoformat()}|{seq}"
                self.right.update((*value, ts, name))
                for (own,), held in list(self.left.iterator()):
                    own_row, shown, (born, seen) = held[: len(l_at)], held[len(l_at) : -2], held[-2:]
                    if ts - born > self.life:
                        self.left.removeKey((own,))
                        continue
                    if seen or not self.inner:
                        out.append((*own_row, *shown, *at, -1, f"{own}#{seen}"))
                    out.append((*own_row, *value, *at, 1, f"{own}#{name}"))
                    self.left.updateValue((own,), (*own_row, *value, born, name))
            elif sign > 0:
                own_row = tuple(_cell(row[i], kind) for i, kind in l_at)
                current = self.right.get() if self.right.exists() else None
                live = current is not None and ts - current[-2] <= self.life
                value, seen = (tuple(current[:-2]), current[-1]) if live else (nothing, "")
                if live or not self.inner:
                    out.append((*own_row, *value, *at, 1, f"{origin}#{seen}"))
                self.left.updateValue((origin,), (*own_row, *value, ts, seen))
            elif self.left.containsKey((origin,)):
                held = self.left.getValue((origin,))
                if held[-1] or not self.inner:
                    out.append((*held[:-2], *at, -1, f"{origin}#{held[-1]}"))
                self.left.removeKey((origin,))
        self.handle.registerTimer(int((ts + self.life).timestamp() * 1000) + 1)
        if out:
            yield _frame(out, self.output)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """What has outlived its span can meet nothing more, nor be taken back: its own side had the same span."""
        passed = expiredTimerInfo.getExpiryTimeInMs()
        over = lambda born: (born + self.life).timestamp() * 1000 < passed
        for (own,), held in list(self.left.iterator()):
            if over(held[-2]):
                self.left.removeKey((own,))
        if self.right.exists() and over(self.right.get()[-2]):
            self.right.clear()
        yield from ()

    def close(self) -> None:
        pass


def _tagged(left: DataFrame, right: DataFrame, on: dict[str, str]) -> tuple[DataFrame, list[T.StructField], list[T.StructField]]:
    keys = {f"k{n}": pair for n, pair in enumerate(on.items())}
    place = [*AT, "sign", "origin"]
    own = [f for f in left.schema.fields if f.name not in place]
    other = [f for f in right.schema.fields if f.name not in (*on.values(), *AT)]
    lefts = left.select(
        *[F.col(a).alias(k) for k, (a, _) in keys.items()], *[f.name for f in own],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in other], *place,
    )
    rights = right.select(
        *[F.col(b).alias(k) for k, (_, b) in keys.items()], *[F.lit(None).cast(f.dataType).alias(f.name) for f in own],
        *[f.name for f in other], *AT, F.lit(0).alias("sign"), F.lit("").alias("origin"),
    )
    # A null is a group like others, with rows of the left alone.
    return lefts.unionByName(rights.dropna(subset=list(keys))), own, other


def join_over_time(left: DataFrame, right: DataFrame, on: dict[str, str], life: int, how: str = "left") -> DataFrame:
    """Stream form of :func:`millrace.operators.changelog.join_over_time`.

    ``left`` has its columns, at_ts, at_side, at_seq, sign and origin (different for each of its rows); ``right`` its
    columns, at_ts, at_side and at_seq. Both carry a watermark on at_ts. Rows of the right without a key meet nothing;
    rows of the left without one come out as they are, with nulls, from a left join.
    """
    tagged, own, other = _tagged(left, right, on)
    processor = JoinOverTime(own, other, life, how == "inner")
    return tagged.groupBy(*[f"k{n}" for n in range(len(on))]).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="at_ts",
    )


def side_events(df: DataFrame, side: int, ts: str, seq: list[str], take: list[str], delay: str) -> DataFrame:
    """Stream form of :func:`millrace.operators.changelog.events`, with a watermark; an event must come once."""
    placed = changelog.placed_events(df, side, ts, seq, take)
    flat = placed.select(*take, F.col("at.ts").alias("at_ts"), F.col("at.side").alias("at_side"), F.col("at.seq").alias("at_seq"))
    return flat.withWatermark("at_ts", delay)


def wide_changelog(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame, life: int, delay: str) -> DataFrame:
    """Stream form of :func:`millrace.operators.changelog.wide_changelog`: three joins in one query."""
    order, detail, activity, coupon = (
        side_events(frame.withColumnRenamed("id", "order_id") if n == changelog.ORDERS else frame, n, "ts", seq, take, delay)
        for n, (frame, (seq, take)) in enumerate(zip((orders, details, activities, coupons), changelog.wide_columns(details)))
    )
    first = detail.withColumns({"sign": F.lit(1), "origin": F.col("at_seq")})
    wide = join_over_time(first, order, {"order_id": "order_id"}, life, "inner")
    wide = join_over_time(wide, activity, {"id": "order_detail_id"}, life)
    return join_over_time(wide, coupon, {"id": "order_detail_id"}, life)


# A table's changes are dealt over so many keys, as one table may send most of them; each gets the configuration.
CONFIG_PARTS = 32


class RouteByConfig(StatefulProcessor):
    """One part of a source table's changes, with the entry that is in force as state."""

    OUTPUT = T.StructType(
        [*[T.StructField(n, T.StringType()) for n in ("sink_table", "sink_columns", "after")], T.StructField("ts", T.TimestampType())]
    )

    def init(self, handle):
        self.entry = handle.getValueState("entry", "sink_table string, sink_columns string")

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, ["ts", "kind", "op", "sink_table", "sink_columns"])
        if frame is None:
            return
        entry, out = self.entry.get() if self.entry.exists() else None, []
        before = entry
        for ts, kind, op, table, columns, after in zip(*[frame[c] for c in ("ts", "kind", "op", "sink_table", "sink_columns", "after")]):
            if kind == 0:
                entry = None if op == "d" else (table, columns)
            elif entry is not None:
                out.append((*entry, after, ts))
        if entry is None:
            self.entry.clear()
        elif entry != before:
            self.entry.update(entry)
        if out:
            yield _frame(out, self.OUTPUT)

    def close(self) -> None:
        pass


def route_facts(changes: DataFrame, history: DataFrame) -> DataFrame:
    """Stream form of :func:`millrace.operators.cdc.route_fact_as_of`: changes and configuration as two streams.

    Both have an event time ``ts``; ``history`` has source_table, sink_table, sink_columns and op. An entry goes to all parts
    of its table. Changes that come before the first entry of their table go nowhere.
    """
    nothing = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    rows = changes.where((F.col("op") != "d") & F.col("after").isNotNull()).select(
        F.col("source")["table"].alias("source_table"), F.pmod(F.xxhash64(F.to_json("after")), F.lit(CONFIG_PARTS)).alias("part"),
        "ts", F.lit(1).alias("kind"), *nothing("op", "sink_table", "sink_columns"), F.to_json("after").alias("after"),
    )
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(CONFIG_PARTS - 1).cast("bigint")))
    entries = history.select("source_table", parts.alias("part"), "ts", F.lit(0).alias("kind"), "op", "sink_table", "sink_columns", *nothing("after"))
    routed = rows.unionByName(entries).groupBy("source_table", "part").transformWithStateInPandas(
        statefulProcessor=RouteByConfig(), outputStructType=RouteByConfig.OUTPUT, outputMode="Append", timeMode="None"
    )
    payload = keys.keep_keys(F.from_json("after", "map<string,string>"), F.split("sink_columns", ","))
    return routed.select("sink_table", payload.alias("payload"), F.unix_millis("ts").alias("ts"))


class QuietSpells(StatefulProcessor):
    """One key of :func:`millrace.operators.temporal.emissions_after_quiet`.

    Open spells are kept with their bounds and the version held; a late row can extend or join them. A timer at the
    end of the wait emits a spell, as nothing older can come then.
    """

    def __init__(self, schema: T.StructType, ts: str, order: list[str], quiet: int):
        self.schema, self.ts, self.order, self.quiet = schema, schema.names.index(ts), order, timedelta(seconds=quiet)
        self.rank = [schema.names.index(c) for c in order]
        self.output = T.StructType([*schema.fields, T.StructField("emit_ts", T.TimestampType())])

    def init(self, handle):
        self.handle = handle
        bounds = [T.StructField("__first", T.TimestampType()), T.StructField("__last", T.TimestampType())]
        self.spells = handle.getListState("spells", T.StructType([*self.schema.fields, *bounds]))

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, self.order)
        if frame is None:
            return
        spells = [tuple(s) for s in self.spells.get()] if self.spells.exists() else []
        for row in frame[self.schema.names].itertuples(index=False, name=None):
            held = tuple(_cell(v, f.dataType) for v, f in zip(row, self.schema.fields))
            merged = (*held, held[self.ts], held[self.ts])
            apart = []
            for spell in spells:
                if merged[-2] - spell[-1] > self.quiet or spell[-2] - merged[-1] > self.quiet:
                    apart.append(spell)
                    continue
                newer = max(merged, spell, key=lambda s: [s[i] for i in self.rank])
                merged = (*newer[:-2], min(merged[-2], spell[-2]), max(merged[-1], spell[-1]))
            spells = [*apart, merged]
            self.handle.registerTimer(int((merged[-1] + self.quiet).timestamp() * 1000) + 1)
        self.spells.put(spells)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = expiredTimerInfo.getExpiryTimeInMs()
        spells = [tuple(s) for s in self.spells.get()] if self.spells.exists() else []
        over = [s for s in spells if (s[-1] + self.quiet).timestamp() * 1000 < passed]
        if not over:
            return
        left = [s for s in spells if s not in over]
        self.spells.put(left) if left else self.spells.clear()
        yield _frame([(*s[:-2], s[-1] + self.quiet) for s in over], self.output)

    def close(self) -> None:
        pass


def emissions_after_quiet(df: DataFrame, key: str, ts: str, order: list[str], quiet: int) -> DataFrame:
    """Stream form of :func:`millrace.operators.temporal.emissions_after_quiet`; ``df`` has a watermark on ``ts``."""
    processor = QuietSpells(df.schema, ts, order, quiet)
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Append", timeMode="EventTime",
    )


class SignedVersions(StatefulProcessor):
    """Each version of a detail and the negation of the one before it, with the time of the version behind both."""

    def __init__(self, schema: T.StructType, order: list[str]):
        self.schema, self.order = schema, order
        added = [T.StructField("sign", T.IntegerType()), T.StructField("at_ts", T.TimestampType()), T.StructField("at_n", T.LongType())]
        self.output = T.StructType([*schema.fields, *added])

    def init(self, handle):
        self.last = handle.getValueState("last", T.StructType([*self.schema.fields, T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, self.order)
        if frame is None:
            return
        before = tuple(self.last.get()) if self.last.exists() else None
        ts, out = self.schema.names.index("ts"), []
        for row in frame[self.schema.names].drop_duplicates().itertuples(index=False, name=None):
            own = tuple(_cell(v, f.dataType) for v, f in zip(row, self.schema.fields))
            n = before[-1] + 1 if before else 0
            if before:
                out.append((*before[:-1], -1, own[ts], n))
            out.append((*own, 1, own[ts], n))
            before = (*own, n)
        self.last.update(before)
        yield _frame(out, self.output)

    def close(self) -> None:
        pass


class OrderTotals(StatefulProcessor):
    """Orders and amount of one (window, province) after each signed version.

    How often each order is in lies in map state: an update rewrites one entry, and no set is built.
    """

    def __init__(self, output: T.StructType):
        self.output = output

    def init(self, handle):
        self.held = handle.getMapState("held", "order_id string", "n bigint")
        self.totals = handle.getValueState("totals", "orders bigint, amount decimal(38,2)")

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, ["at_ts", "part", "id", "at_n", "sign"])
        if frame is None:
            return
        orders, amount = self.totals.get() if self.totals.exists() else (0, 0)
        out = []
        for order, ident, value, sign, at in zip(*[frame[c] for c in ("order_id", "id", "split_total_amount", "sign", "at_ts")]):
            before = self.held.getValue((order,))[0] if self.held.containsKey((order,)) else 0
            after = before + int(sign)
            orders += (after > 0) - (before > 0)
            amount += value * int(sign)
            self.held.updateValue((order,), (after,)) if after else self.held.removeKey((order,))
            out.append((key[0], key[1], order, ident, int(sign), at, orders, amount))
        self.totals.update((orders, amount))
        yield _frame(out, self.output)

    def close(self) -> None:
        pass


class SkuTotals(StatefulProcessor):
    """Amounts of one (window, sku) after each signed version."""

    def __init__(self, output: T.StructType):
        self.output = output

    def init(self, handle):
        self.totals = handle.getValueState("totals", ", ".join(f"{c} decimal(38,2)" for c in SKU_AMOUNTS))

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, ["at_ts", "part", "id", "at_n", "sign"])
        if frame is None:
            return
        totals = list(self.totals.get()) if self.totals.exists() else [0] * len(SKU_AMOUNTS)
        out = []
        for ident, sign, at, *values in zip(*[frame[c] for c in ("id", "sign", "at_ts", *SKU_AMOUNTS)]):
            totals = [t + v * int(sign) for t, v in zip(totals, values)]
            out.append((*key, ident, int(sign), at, *totals))
        self.totals.update(tuple(totals))
        yield _frame(out, self.output)

    def close(self) -> None:
        pass


def _signed_stream(details: DataFrame, order: list[str], delay: str, width: str) -> DataFrame:
    """Signed versions with the start of their own window, as a number: a window column would be one of the stream's."""
    signer = SignedVersions(details.schema, order)
    signed = details.withWatermark("ts", delay).groupBy("id").transformWithStateInPandas(
        statefulProcessor=signer, outputStructType=signer.output, outputMode="Append", timeMode="EventTime", eventTimeColumnName="at_ts",
    )
    length = F.lit(int(pd.Timedelta(width).total_seconds()))
    start = F.floor(F.unix_seconds("ts") / length) * length
    return signed.withColumns({"window_start": start.cast("bigint"), "part": F.substring(F.md5("id"), 1, 2)})


def sku_order_emissions(details: DataFrame, order: list[str], delay: str, width: str = "5 seconds") -> DataFrame:
    """Stream form of :func:`millrace.operators.trade.sku_order_emissions`, with the window's start in seconds."""
    output = T.StructType.fromDDL(
        "window_start bigint, sku_id string, id string, sign int, at_ts timestamp, " + ", ".join(f"{n} decimal(38,2)" for n in SKU_AMOUNTS.values())
    )
    return _signed_stream(details, order, delay, width).groupBy("window_start", "sku_id").transformWithStateInPandas(
        statefulProcessor=SkuTotals(output), outputStructType=output, outputMode="Append", timeMode="EventTime", eventTimeColumnName="at_ts",
    )


def province_order_emissions(details: DataFrame, order: list[str], delay: str, width: str = "10 seconds") -> DataFrame:
    """Stream form of :func:`millrace.operators.trade.province_order_emissions`, with the window's start in seconds.

    Two stateful operators in one query: versions by detail, totals by window and province. The time of the version
    behind a row goes through as event time; a negation's window may be long past.
    """
    output = T.StructType.fromDDL(
        "window_start bigint, province_id string, order_id string, id string, sign int, at_ts timestamp, order_count bigint, "
        "order_amount decimal(38,2)"
    )
    return _signed_stream(details, order, delay, width).groupBy("window_start", "province_id").transformWithStateInPandas(
        statefulProcessor=OrderTotals(output), outputStructType=output, outputMode="Append", timeMode="EventTime", eventTimeColumnName="at_ts",
    )


class DeviceRunning(StatefulProcessor):
    """One user of :func:`millrace.operators.labels.user_device_running`: each value seen is one entry of map state."""

    COUNTS = ["pv", *[f"n_{f}" for f in DEVICE_FIELDS]]

    def init(self, handle):
        self.seen = handle.getMapState("seen", "field string, value string", "n bigint")
        self.counts = handle.getValueState("counts", ", ".join(f"{c} bigint" for c in self.COUNTS))

    def handleInputRows(self, key, rows, timerValues):
        frame = _ordered(rows, ["ts", "seq"])
        if frame is None:
            return
        counts = list(self.counts.get()) if self.counts.exists() else [0] * len(self.COUNTS)
        out = []
        for row in frame[["uid", "ts", "seq", *DEVICE_FIELDS]].itertuples(index=False, name=None):
            counts[0] += 1
            for n, (field, value) in enumerate(zip(DEVICE_FIELDS, row[3:]), start=1):
                if value and not pd.isna(value) and not self.seen.containsKey((field, value)):
                    self.seen.updateValue((field, value), (1,))
                    counts[n] += 1
            out.append((*row[:3], *counts))
        self.counts.update(tuple(counts))
        yield pd.DataFrame(out, columns=["uid", "ts", "seq", *self.COUNTS])

    def close(self) -> None:
        pass


def user_device_running(flat: DataFrame) -> DataFrame:
    """``flat`` has uid, ts, seq and the device fields and phrase as columns."""
    schema = "uid string, ts timestamp, seq bigint, " + ", ".join(f"{c} bigint" for c in DeviceRunning.COUNTS)
    return flat.groupBy("uid").transformWithStateInPandas(
        statefulProcessor=DeviceRunning(), outputStructType=schema, outputMode="Append", timeMode="None"
    )
