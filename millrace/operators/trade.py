"""Windowed trade summaries and the product dimension chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import times
from millrace.operators.joins import enrich
from millrace.operators.running import Running, latest_per_key, running

SKU_AMOUNTS = {
    "split_original_amount": "original_amount",
    "split_activity_amount": "activity_reduce_amount",
    "split_coupon_amount": "coupon_reduce_amount",
    "split_total_amount": "order_amount",
}


def _money(total: Column) -> Column:
    return total.cast("decimal(16,2)")


def _counted(details: DataFrame, order: list[str], by: list[str], amounts: list[str]) -> DataFrame:
    """Every detail's cell with amount 0, and the last version of each detail with its amounts.

    Summed per cell this equals the sum over :func:`~millrace.operators.dedup.retract_dedup`: a
    replaced detail and its negation lie in the same cell and cancel, and cells where everything was
    taken back remain with 0. It needs no window over the versions of a detail: the last version is
    an aggregate, and the zero rows collapse in the map-side half of the sum that follows.
    """
    cell = [F.window("ts", by[0]).alias("window"), *by[1:]]
    last = latest_per_key(details.select("id", *dict.fromkeys([*order, *by[1:], *amounts])), ["id"], order)
    nothing = [F.lit(0).cast("decimal(16,2)").alias(c) for c in amounts]
    cells = details.select(*cell, *nothing)
    return cells.unionByName(last.select(*cell, *amounts))


def sku_order_window(details: DataFrame, order: list[str], width: str = "5 seconds") -> DataFrame:
    """Amounts per window and sku after retraction of replaced details.

    ``order`` is a total order of a detail's versions; ``details`` is the detail fact.
    """
    counted = _counted(details, order, [width, "sku_id"], list(SKU_AMOUNTS))
    summed = counted.groupBy("window", "sku_id").agg(
        *[_money(F.sum(c)).alias(name) for c, name in SKU_AMOUNTS.items()]
    )
    return summed.select(*times.window_bounds(F.col("window")), "sku_id", *SKU_AMOUNTS.values())


def province_order_window(details: DataFrame, provinces: DataFrame, order: list[str], width: str = "10 seconds") -> DataFrame:
    """Order count and amount per window and province after retraction, with the province's name.

    Orders are counted by first reducing to one row per (window, province, order), so a province with
    a third of all orders is spread over the order id and no set of ids is ever built.
    """
    counted = _counted(details, order, [width, "province_id", "order_id"], ["split_total_amount"])
    per_order = counted.groupBy("window", "province_id", "order_id").agg(
        F.sum("split_total_amount").alias("amount")
    )
    summed = per_order.groupBy("window", "province_id").agg(
        F.count(F.lit(1)).alias("order_count"), _money(F.sum("amount")).alias("order_amount")
    )
    named = enrich(summed, provinces, {"province_id": "id"}, {"name": "province_name"})
    return named.select(
        *times.window_bounds(F.col("window")), "province_id", "province_name", "order_count", "order_amount"
    )


def _signed(amount: str) -> Column:
    """The amount with the row's sign, in its own type."""
    return F.when(F.col("sign") < 0, -F.col(amount)).otherwise(F.col(amount))


def _window_from(start: str, width: str) -> Column:
    """The tumbling window that begins at a column."""
    return F.struct(F.col(start).alias("start"), (F.col(start) + F.expr(f"INTERVAL {width}")).alias("end"))


def _part(id: str) -> Column:
    """The first two digits of an id's hash."""
    return F.substring(F.md5(id), 1, 2)


def signed_details(details: DataFrame, order: list[str], slice_by: Column) -> DataFrame:
    """Each version of a detail (sign 1) and its negation (sign -1), with the position of the version behind it.

    ``at`` is the position: time of the version that caused the row, the first two digits of the id's hash (so that
    rows of one time can be split), the id, then the version's number within its id and slice. ``order`` starts with
    ``ts``, which ``slice_by`` follows, so the number only decides among an id's versions of one time. Versions that are
    equal in all columns are one.

    Rows are dealt once, by (id, slice). What the last version of a slice needs, the time of the id's next slice, is
    one row per (id, slice), taken from the same exchange.
    """
    dealt = details.repartition("id", slice_by).withColumn("__slice", slice_by).dropDuplicates()
    within = Window.partitionBy("id", "__slice").orderBy(*order)
    numbered = dealt.withColumns({"__n": F.row_number().over(within), "__next": F.lead("ts").over(within)})
    # The count asks for the rows as they are without repeats, and so for the same exchange.
    starts = dealt.groupBy("id", "__slice").agg(F.min("ts").alias("__start"), F.count(F.lit(1)).alias("__rows")).where("__rows > 0")
    further = starts.drop("__rows").withColumn("__then", F.lead("__start").over(Window.partitionBy("id").orderBy("__slice")))
    linked = numbered.join(further.where(F.col("__then").isNotNull()).drop("__start"), ["id", "__slice"], "left")

    def place(ts: Column, n: Column) -> Column:
        return F.struct(ts.alias("ts"), _part("id").alias("part"), F.col("id").alias("id"), n.alias("n"))

    following = F.when(F.col("__next").isNotNull(), place(F.col("__next"), F.col("__n") + 1)).when(
        F.col("__then").isNotNull(), place(F.col("__then"), F.lit(1))
    )
    signs = F.array(
        F.struct(place(F.col("ts"), F.col("__n")).alias("at"), F.lit(1).alias("sign")),
        F.struct(following.alias("at"), F.lit(-1).alias("sign")),
    )
    signed = linked.select(*details.columns, F.explode(signs).alias("__s")).where(F.col("__s.at").isNotNull())
    return signed.select(*details.columns, "__s.at", "__s.sign")


def province_order_emissions(
    details: DataFrame, order: list[str], slice_by: Column, width: str = "10 seconds", hot_windows: bool = False
) -> DataFrame:
    """What the windows of :func:`province_order_window` hold after each version and each negation.

    One row per signed version: its window and province, the different orders in there and their amount, by then.
    An order counts while at least one of its versions does, so each (window, province, order) carries how often it
    is in. A negation belongs to the window of the row that it takes back, however late it comes. ``order`` starts
    with ``ts``; ``slice_by`` cuts a detail's versions.

    The signed versions are dealt once, by window and province, so a province with a third of all rows is as many tasks as
    it has windows. With ``hot_windows`` also one window of a province is many tasks, cut by (time, part of the id), for
    which rows and sums are moved several times.
    """
    signed = signed_details(details, order, slice_by)
    rows = signed.select(
        F.window("ts", width)["start"].alias("start"), "province_id", "order_id", "split_total_amount", "sign",
        F.col("at.ts").alias("at_ts"), F.col("at.id").alias("id"), F.col("at.n").alias("n"),
    )
    # What the id's hash says of a position isn't carried.
    at, cut = F.struct("at_ts", _part("id").alias("part"), "id", "n"), F.struct("at_ts", _part("id").alias("part"))
    counted = _cut_windows(rows, at, cut) if hot_windows else _whole_windows(rows, at, cut)
    return counted.select(
        *times.window_bounds(_window_from("start", width)), "province_id", "order_id", "id", "sign", "at_ts",
        "order_count", _money(F.col("order_amount")).alias("order_amount"),
    )


def _whole_windows(rows: DataFrame, at: Column, cut: Column) -> DataFrame:
    """The running count of orders and amount of each window and province, from one exchange."""
    dealt = rows.repartition("start", "province_id")
    # Rows without a province are no cell together; those of one cut are.
    cell = ["start", "province_id", F.when(F.col("province_id").isNull(), cut)]
    through = Window.partitionBy(*cell, "order_id").orderBy(at, "sign").rowsBetween(Window.unboundedPreceding, 0)
    after = dealt.withColumn("__after", F.sum(F.col("sign").cast("bigint")).over(through))
    before = F.col("__after") - F.col("sign")
    changed = after.withColumn("__change", (F.col("__after") > 0).cast("bigint") - (before > 0).cast("bigint"))
    so_far = Window.partitionBy(*cell).orderBy(at, "sign").rowsBetween(Window.unboundedPreceding, 0)
    amount = F.coalesce(F.sum(_signed("split_total_amount")).over(so_far), F.lit(0))
    return changed.withColumns({"order_count": F.sum("__change").over(so_far), "order_amount": amount})


def _cut_windows(rows: DataFrame, at: Column, cut: Column) -> DataFrame:
    """The same with every window cut."""
    here = [
        Running("__before", "sum", F.col("sign").cast("bigint")),
        Running("__after", "sum", F.col("sign").cast("bigint"), through=True),
    ]
    per_order = running(rows.withColumn("at", at), ["start", "province_id", "order_id"], ["at", "sign"], cut, here, dealt_once=True)
    change = (F.col("__after") > 0).cast("bigint") - (F.col("__before") > 0).cast("bigint")
    totals = [
        Running("order_count", "sum", F.col("__change"), through=True),
        Running("order_amount", "sum", _signed("split_total_amount"), through=True),
    ]
    changes = per_order.withColumn("__change", change).drop("__before", "__after")
    return running(changes, ["start", "province_id"], ["at", "sign"], cut, totals, dealt_once=True)


def sku_order_emissions(details: DataFrame, order: list[str], slice_by: Column, width: str = "5 seconds") -> DataFrame:
    """What the windows of :func:`sku_order_window` hold after each version and each negation, one row per signed version.

    As :func:`province_order_emissions`, for the amounts of a sku.
    """
    signed = signed_details(details, order, slice_by)
    rows = signed.select(F.window("ts", width)["start"].alias("start"), "sku_id", *SKU_AMOUNTS, "sign", "at")
    cut = F.struct("at.ts", "at.part")
    totals = [Running(f"__{name}", "sum", _signed(c), through=True) for c, name in SKU_AMOUNTS.items()]
    counted = running(rows, ["start", "sku_id"], ["at", "sign"], cut, totals, dealt_once=True)
    return counted.select(
        *times.window_bounds(_window_from("start", width)), "sku_id", F.col("at.id").alias("id"), "sign", F.col("at.ts").alias("at_ts"),
        *[_money(F.col(f"__{name}")).alias(name) for name in SKU_AMOUNTS.values()],
    )


def sku_dim_chain(
    df: DataFrame,
    sku: DataFrame,
    spu: DataFrame,
    trademark: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
) -> DataFrame:
    """Six lookups: sku, spu, trademark, category 3, 2 and 1. A missing dimension gives null names."""
    out = enrich(
        df,
        sku,
        {"sku_id": "id"},
        {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "trademark_id", "category3_id": "category3_id"},
    )
    out = enrich(out, spu, {"spu_id": "id"}, {"spu_name": "spu_name"})
    out = enrich(out, trademark, {"trademark_id": "id"}, {"tm_name": "trademark_name"})
    out = enrich(out, category3, {"category3_id": "id"}, {"name": "category3_name", "category2_id": "category2_id"})
    out = enrich(out, category2, {"category2_id": "id"}, {"name": "category2_name", "category1_id": "category1_id"})
    return enrich(out, category1, {"category1_id": "id"}, {"name": "category1_name"})


def category_hierarchy(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """Category 3 with the names of its two parents."""
    c3 = category3.select(F.col("id"), F.col("name").alias("b3name"), F.col("category2_id").alias("__c2"))
    c2 = category2.select(F.col("id").alias("__c2"), F.col("name").alias("b2name"), F.col("category1_id").alias("__c1"))
    c1 = category1.select(F.col("id").alias("__c1"), F.col("name").alias("b1name"))
    return c3.join(c2, "__c2").join(c1, "__c1").select("id", "b3name", "b2name", "b1name")


def sku_snapshot(sku: DataFrame, spu: DataFrame, trademark: DataFrame) -> DataFrame:
    """Sku with its spu, the spu's category and the trademark's name."""
    s = sku.select(F.col("id").alias("skuid"), F.col("spu_id").alias("spuid"))
    p = spu.select(F.col("id").alias("spuid"), F.col("category3_id").alias("c3id"), F.col("tm_id").alias("__tm"))
    t = trademark.select(F.col("id").alias("__tm"), F.col("tm_name").alias("tname"))
    return s.join(p, "spuid").join(t, "__tm").select("skuid", "spuid", "c3id", "tname")
