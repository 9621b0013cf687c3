"""Joins whose result is a changelog: every row with the event that made it and the event that took it back.

A join of streams keeps its inputs for a while and emits rows as events arrive. In batch the same result has
a closed form. Each row of the result is visible from one event to another, so a frame of rows with ``born``
and ``gone`` states the whole changelog, and a join turns one such frame into another. Events are put in
order by their position: time, side and sequence.

The right side is a keyed table: an event replaces the key's earlier one. A left row meets the right event
that is current at its birth and those that follow, as long as they lie within the life span of the kept state,
counted from the left row's birth. A left join shows nulls from birth until the first match.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.running import has_map

POSITION = "struct<ts:timestamp,side:int,seq:string>"
# A stretch of time in life spans: the longer, the fewer rows lie in two of them, and the more of a hot key lies in one.
LIVES = 4


def position(ts: Column, side: int, seq: Column) -> Column:
    """Where an event stands among those of all sides."""
    return F.struct(ts.alias("ts"), F.lit(side).alias("side"), seq.alias("seq"))


def _text(df: DataFrame, columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def placed_events(df: DataFrame, side: int, ts: str, seq: list[str], take: list[str]) -> DataFrame:
    """Upserts of a side: the columns ``take`` and their position ``at``.

    ``seq`` orders events of one time; its columns are joined as text. Rows without a time have no place in a
    stream and are left out.
    """
    return df.where(F.col(ts).isNotNull()).select(*take, position(F.col(ts), side, _text(df, seq)).alias("at"))


@dataclass(frozen=True)
class Events:
    """A side's upserts as they came: rows that are equal are one event, which counts once it was dealt.

    The columns ``take``, a time and, among events of one time, an order by the text of ``seq``, which is made after the
    rows were dealt.
    """

    rows: DataFrame
    side: int
    ts: str
    seq: list[str]
    take: list[str]

    def dealt(self, by: list[str], more: dict[str, Column]) -> DataFrame:
        """Each event once with its position ``at``; those with the same values of ``by`` and ``more`` lie together."""
        rows = self.rows.withColumns(more).repartition(*by, *more).dropDuplicates()
        return rows.select(*self.take, *more, position(F.col(self.ts), self.side, _text(rows, self.seq)).alias("at"))


def events(df: DataFrame, side: int, ts: str, seq: list[str], take: list[str]) -> Events:
    """Rows without a time have no place in a stream and are left out. ``seq`` is some of ``take``, which have an order."""
    return Events(df.where(F.col(ts).isNotNull()).select(*dict.fromkeys([*take, ts])), side, ts, seq, take)


def join_over_time(left: DataFrame | Events, rights: list[Events], on: dict[str, str], life: int, how: str = "left") -> DataFrame:
    """The changelog of a join of the changelog ``left`` with the upserts ``rights``, one after the other by the same columns.

    ``on`` maps columns of the left to key columns of each right, ``life`` is in seconds. Events as the left side are what
    nothing takes back. Time is cut into stretches of LIVES life spans, which spreads a hot key. A left row lies in the
    stretch of its birth, also after a join gave it a later one; a right row, which is the narrower one, is repeated in
    the stretches that it can be reached from, a life span further for each join before. So a left row goes through one
    exchange, whatever the number of rights, and meets all its events in one place. The rows of ``left`` must differ in their
    columns, ``born`` included, as events and the result of this function do.
    """
    width = max(LIVES * life, 1) * 1_000_000

    def stretch(ts: str, shift: int) -> Column:
        return F.floor((F.unix_micros(F.col(ts)) + F.lit(shift * 1_000_000)) / F.lit(width)).cast("bigint")

    def home(df: DataFrame, ts: str) -> Column:
        # Rows without a key meet nothing, so they lie anywhere.
        keyless = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
        own = [c for c in df.columns if not has_map(df.schema[c].dataType)]
        return F.when(keyless, F.xxhash64(*own)).otherwise(stretch(ts, 0))

    if isinstance(left, Events):
        placed = left.dealt([*on], {"__stretch": home(left.rows, left.ts)})
        out = placed.select(*left.take, "__stretch", F.col("at").alias("born"), F.lit(None).cast(POSITION).alias("gone"))
    else:
        out = left.withColumn("__stretch", home(left, "born.ts"))
    for n, right in enumerate(rights, 1):
        near = F.explode(F.sequence(stretch(right.ts, -n * life), stretch(right.ts, life)))
        known = replace(right, rows=right.rows.dropna(subset=[*on.values()]))
        out = _joined(out, known.dealt([*on.values()], {"__there": near}), on, life, how)
    return out.drop("__stretch")


def _joined(left: DataFrame, right: DataFrame, on: dict[str, str], life: int, how: str) -> DataFrame:
    """One join of those; rows that can meet have the same ``__stretch`` and ``__there``."""
    keys = [f"__k{n}" for n in range(len(on))]
    taken = [c for c in right.columns if c not in (*on.values(), "__there", "at")]
    side = right.select(*[F.col(c).alias(k) for c, k in zip(on.values(), keys)], "__there", *taken, F.col("at").alias("__at"))
    gap = F.unix_micros("__at.ts") - F.unix_micros("born.ts")
    meets = gap.between(-life * 1_000_000, life * 1_000_000) & (F.col("gone").isNull() | (F.col("__at") < F.col("gone")))
    same = [F.col(c) == F.col(k) for c, k in zip((*on, "__stretch"), (*keys, "__there"))]
    met = left.join(side, [*same, meets], how).drop(*keys, "__there")

    own = [c for c in left.columns if not has_map(left.schema[c].dataType)]
    each = Window.partitionBy(*own).orderBy("__at")
    following = met.withColumns({"__next": F.lead("__at").over(each), "__n": F.row_number().over(each)})
    # Of the events before the birth only the last one is current; nulls are shown until the first event.
    shown = F.col("__at").isNotNull() & (F.col("__next").isNull() | (F.col("__next") > F.col("born")))
    bare = (F.col("__n") == 1) & (F.col("__at").isNull() | (F.col("__at") > F.col("born")))
    spans = [F.when(shown, F.struct(F.col("__at").alias("since"), F.col("__next").alias("until")))]
    if how != "inner":
        spans.append(F.when(bare, F.struct(F.lit(None).cast(POSITION).alias("since"), F.col("__at").alias("until"))))
    spanned = following.withColumn("__span", F.explode(F.filter(F.array(*spans), lambda s: s.isNotNull())))
    return spanned.select(
        *[c for c in left.columns if c not in ("born", "gone")],
        *[F.when(F.col("__span.since").isNotNull(), F.col(c)).alias(c) for c in taken],
        F.greatest("born", "__span.since").alias("born"), F.least("gone", "__span.until").alias("gone"),
    )


def emitted(rows: DataFrame) -> DataFrame:
    """One row per emission: columns, ``at`` (the event behind it) and ``sign`` (1 shown, -1 taken back)."""
    changes = F.filter(
        F.array(F.struct(F.col("born").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("gone").alias("at"), F.lit(-1).alias("sign"))),
        lambda c: c["at"].isNotNull(),
    )
    plain = [c for c in rows.columns if c not in ("born", "gone")]
    return rows.select(*plain, F.explode(changes).alias("change")).select(*plain, "change.at", "change.sign")


def current(rows: DataFrame) -> DataFrame:
    """What stays when all events are in: the net of the emissions."""
    return rows.where(F.col("gone").isNull()).drop("born", "gone")


# Sides of the wide order detail, in the order that events of one time are taken.
ORDERS, DETAILS, ACTIVITIES, COUPONS = range(4)


def wide_columns(details: DataFrame) -> list[tuple[list[str], list[str]]]:
    """Per side the columns that order events of one time, and those that are taken."""
    plain = [c for c in details.columns if not has_map(details.schema[c].dataType) and c != "ts"]
    return [
        (["order_id", "user_id", "province_id"], ["order_id", "user_id", "province_id"]),
        (plain, [*plain, "ts"]),
        (["activity_id", "activity_rule_id"], ["order_detail_id", "activity_id", "activity_rule_id"]),
        (["coupon_id"], ["order_detail_id", "coupon_id"]),
    ]


def wide_sides(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame) -> list[Events]:
    """Orders, details, activities and coupons as events, by the number of their side."""
    frames = (orders.withColumnRenamed("id", "order_id"), details, activities, coupons)
    # A detail replaces nothing, so its order among those of its time decides nothing and isn't carried.
    return [
        events(f, n, "ts", [] if n == DETAILS else seq, take) for n, (f, (seq, take)) in enumerate(zip(frames, wide_columns(details)))
    ]


def wide_changelog(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame, life: int) -> DataFrame:
    """Order details joined with their order, and left with activity and coupon, as they arrive.

    The net over all time of a life span that covers everything is
    :func:`millrace.operators.facts.order_detail_wide`.
    """
    order, detail, activity, coupon = wide_sides(details, orders, activities, coupons)
    wide = join_over_time(detail, [order], {"order_id": "order_id"}, life, "inner")
    return join_over_time(wide, [activity, coupon], {"id": "order_detail_id"}, life)
