"""Streams that keep rows: their batches add up to the closed forms."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import Window, functions as F

from millrace.functions import keys, times
from millrace.operators import cdc, changelog, facts, labels, logs, search, temporal, trade, traffic
from millrace.plans import batch as batch_plans
from millrace.plans.views import Inputs
from millrace.sources import readers
from millrace.streaming import jobs, joins, tops, windows

DAY = 86_400
FAR = 3_650 * DAY
OUT = ["id", "order_id", "user_id", "sku_id", "sku_num", "province_id", "activity_id", "activity_rule_id", "coupon_id", "sign"]


def sides(inputs, most: int):
    """The four tables of the first orders."""
    few = lambda df, c: df.where(F.split(F.col(c), "-")[0].cast("bigint") <= most)
    return (
        few(inputs.order_detail(), "order_id"), few(inputs.order_info(), "id"), few(inputs.activities(), "order_detail_id"),
        few(inputs.coupons(), "order_detail_id"),
    )


def tagged(details, orders, activities, coupons):
    """One stream's rows, and how its sides are taken out of it again."""
    orders = orders.select(F.col("id").alias("order_id"), "user_id", "province_id", "ts")
    frames = [orders, details, activities, coupons]
    union = None
    for n, df in enumerate(frames):
        own = df.dropDuplicates().withColumn("side", F.lit(n))
        union = own if union is None else union.unionByName(own, allowMissingColumns=True)
    names = [df.columns for df in frames]
    return union, lambda s: [s.where(F.col("side") == n).select(*c) for n, c in enumerate(names)]


def streamed_wide(stream, split, life):
    orders, details, activities, coupons = split(stream)
    return joins.wide_changelog(details, orders.withColumnRenamed("order_id", "id"), activities, coupons, life, "0 seconds")


def test_net_of_the_changelog_is_the_wide_fact(inputs, same):
    parts = inputs.order_detail(), inputs.order_info(), inputs.activities(), inputs.coupons()
    net = changelog.current(changelog.wide_changelog(*parts, FAR))
    wide = facts.order_detail_wide(*parts)
    assert wide.dropDuplicates().count() == wide.count()
    same(net.select(*[c for c in wide.columns if c != "date_id"]), wide.drop("date_id"))
    shown = changelog.emitted(changelog.wide_changelog(*parts, FAR))
    kept = shown.groupBy(*[c for c in shown.columns if c not in ("at", "sign")]).agg(F.sum("sign").alias("n")).where("n <> 0")
    assert kept.where("n <> 1").isEmpty() and kept.count() == wide.count()
    # A row is shown before it is taken back, and no detail is ever shown twice at once.
    running = Window.partitionBy("id", "sku_id", "ts", "sku_num", "split_original_amount").orderBy("at", "sign")
    held = shown.withColumn("held", F.sum("sign").over(running))
    assert held.agg(F.min("held"), F.max("held")).first() == (0, 1)


def test_wide_changelog_streams_with_a_restart(spark, inputs, feed, tmp_path, same):
    """Three joins in one query; half of the files come after the query was stopped and started anew."""
    for life in (FAR, 200 * DAY):
        parts = sides(inputs, 40)
        union, split = tagged(*parts)
        rows = union.orderBy("ts", "side").collect()
        folder, out = str(tmp_path / f"in-{life}"), str(tmp_path / f"out-{life}")
        half = len(rows) // 2
        for at, piece in enumerate((rows[: half // 2], rows[half // 2 : half], rows[half:])):
            if at == 2:
                _run_wide(spark, folder, union.schema, split, life, out, tmp_path)
            spark.createDataFrame(piece, union.schema).coalesce(1).write.mode("append").parquet(folder)
        stream = _run_wide(spark, folder, union.schema, split, life, out, tmp_path)
        got = spark.read.schema(stream.schema).parquet(out).select(*OUT, "at_ts", "at_side")
        batch = changelog.emitted(changelog.wide_changelog(*parts, life))
        same(got, batch.select(*OUT, F.col("at.ts").alias("at_ts"), F.col("at.side").alias("at_side")))


def _run_wide(spark, folder, schema, split, life, out, tmp_path):
    stream = streamed_wide(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), split, life)
    jobs.run_available(stream, f"wide-{life}", jobs.append_batch(out), wait=300, location=str(tmp_path / f"cp-{life}"))
    return stream


def test_hot_order_and_expiry_by_hand(spark, same):
    """One order with many details; an activity before, one after and one beyond the life span."""
    t = datetime(2024, 1, 1)
    at = lambda s: t + timedelta(seconds=s)
    details = spark.createDataFrame([(f"d{n}", "o", at(100)) for n in range(500)] + [("d0", "p", at(5))], "id string, order_id string, ts timestamp")
    orders = spark.createDataFrame([("o", "u", "7", at(98)), ("p", "u", "7", at(60))], "id string, user_id string, province_id string, ts timestamp")
    acts = spark.createDataFrame(
        [("d1", "early", "r", at(95)), ("d2", "late", "r", at(104)), ("d3", "gone", "r", at(120)), ("d1", "second", "r", at(107))],
        "order_detail_id string, activity_id string, activity_rule_id string, ts timestamp",
    )
    none = spark.createDataFrame([], "order_detail_id string, coupon_id string, ts timestamp")
    got = changelog.emitted(changelog.wide_changelog(details, orders, acts, none, 10))
    rows = {}
    for r in got.collect():
        rows.setdefault(r.id, []).append(((r["at"].ts - t).seconds, r.sign, r.activity_id))
    assert len(rows) == 500 and sorted(rows["d0"]) == [(100, 1, None)]  # p came 55 s late
    assert sorted(rows["d1"]) == [(100, 1, "early"), (107, -1, "early"), (107, 1, "second")]
    assert sorted(rows["d2"], key=str) == [(100, 1, None), (104, -1, None), (104, 1, "late")]
    assert rows["d3"] == [(100, 1, None)]


def test_lookup_as_of(spark, same):
    t = datetime(2024, 1, 1)
    at = lambda s: t + timedelta(seconds=s) if s is not None else None
    versions = spark.createDataFrame(
        [("a", "u", 1, at(10)), ("a", "u", 2, at(20)), ("a", "u", 3, at(20)), ("a", "d", None, at(30)), ("a", "u", 4, at(40)), ("b", "u", None, at(1)), ("a", "u", 9, None)],
        "k string, op string, v int, ts timestamp",
    )
    asked = [("a", s) for s in (5, 10, 19, 20, 25, 30, 35, 40, 99)] + [("b", 2), ("c", 2), (None, 2), ("a", None), ("a", 19)]
    facts_of = spark.createDataFrame([(k, at(s), s) for k, s in asked], "k string, ts timestamp, s int")
    for width in (1, 7, 10**6):
        found = temporal.lookup_as_of(
            facts_of, versions, {"k": "k"}, "ts", "ts", ["op", "v"], {"v": "found"}, times.seconds_slice(F.col("ts"), width), F.col("op") == "d"
        )
        want = [None, 1, 1, 3, 3, None, None, 4, 4, None, None, None, None, 1]
        same(found, spark.createDataFrame([(k, at(s), s, w) for (k, s), w in zip(asked, want)], "k string, ts timestamp, s int, found int"))


def test_snapshot_handover_gives_each_row_once(spark, inputs):
    """Changes before, within and after the marks; applied in order, the result is the table's last state."""
    out = temporal.snapshot_handover(inputs.order_snapshot(), inputs.order_log(), inputs.order_marks(), "id").collect()
    log = inputs.order_log().join(inputs.order_marks(), "chunk").collect()
    final, marks = {}, {}
    for r in sorted(log, key=lambda r: r.seq):
        final[r.id] = r.after
        marks[r.id] = (r.low, r.high)
    reads = [r for r in out if r.op == "r"]
    assert len({r.id for r in reads}) == len(reads)
    got = {r.id: r.after for r in reads}
    for r in sorted((r for r in out if r.op != "r"), key=lambda r: r.seq):
        assert r.seq > marks[r.id][1]
        got[r.id] = r.after
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in final.items() if v}
    assert any(r.seq <= r.low for r in log) and any(r.low < r.seq <= r.high for r in log) and any(r.seq > r.high for r in log)


def test_a_changing_table_is_read_in_chunks(spark, tmp_path):
    """A table in memory that changes before, between and while its chunks are read."""
    rng = random.Random(9)
    table, log = {}, []

    def change(times_: int) -> None:
        for _ in range(times_):
            key = rng.randrange(40)
            op = "d" if key in table and rng.random() < 0.3 else "u" if key in table else "c"
            row = None if op == "d" else {"v": str(len(log))}
            table.pop(key, None) if op == "d" else table.update({key: row})
            log.append((key // 10, key, len(log) + 1, op, row))

    def read(lower, upper):
        change(3)
        rows = [(k, r) for k, r in sorted(table.items()) if lower <= k < upper]
        change(3)
        return spark.createDataFrame(rows, "id bigint, row map<string,string>")

    change(60)
    snapshot, marks = readers.chunked_snapshot(spark, read, lambda: len(log), [0, 10, 20, 30, 40], str(tmp_path / "chunks"))
    change(40)
    logged = spark.createDataFrame(log, "chunk bigint, id bigint, seq bigint, op string, after map<string,string>")
    out = temporal.snapshot_handover(snapshot, logged, marks, "id").collect()
    reads = [r.id for r in out if r.op == "r"]
    assert len(set(reads)) == len(reads)
    got = {r.id: r.after for r in out if r.op == "r"}
    for r in sorted((r for r in out if r.op != "r"), key=lambda r: r.seq):
        got[r.id] = r.after
    assert {k: v for k, v in got.items() if v} == table


def test_quiet_spells_stream(spark, inputs, feed, run, same):
    details = sides(inputs, 60)[0].select("id", *Inputs.DETAIL_ORDER).dropDuplicates()
    end = details.limit(1).withColumn("id", F.lit("end")).withColumn("ts", F.lit("2030-01-01").cast("timestamp"))
    for n, quiet in enumerate((5, 365 * DAY)):
        batch = temporal.emissions_after_quiet(details, "id", "ts", Inputs.DETAIL_ORDER, quiet, times.seconds_slice(F.col("ts"), DAY))
        source = feed(details.unionByName(end), ["ts", "id"]).withWatermark("ts", "0 seconds")
        same(run(joins.emissions_after_quiet(source, "id", "ts", Inputs.DETAIL_ORDER, quiet), f"quiet{n}").where("id <> 'end'"), batch)


def test_quiet_spells_by_hand(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", t + timedelta(seconds=s), v) for s, v in ((0, 1), (5, 2), (5, 2), (11, 3), (30, 4), (34, 5), (39, 6))] + [(None, t, 0), ("a", None, 0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    for width in (1, 10, 10**6):
        got = temporal.emissions_after_quiet(df, "k", "ts", ["ts", "v"], 5, times.seconds_slice(F.col("ts"), width)).collect()
        assert sorted((r.v, (r.emit_ts - t).seconds) for r in got) == [(2, 10), (3, 16), (6, 44)]


def test_window_emissions_stream(inputs, feed, run, same):
    """Batches come in order; within each one versions come in any order."""
    details = inputs.detail_of_orders().where(F.col("order_id").cast("bigint") <= 60).drop("user_id").dropDuplicates()
    day = times.seconds_slice(F.col("ts"), DAY)
    bounds = lambda width: times.window_bounds(
        F.struct(F.timestamp_seconds("window_start").alias("start"), F.timestamp_seconds(F.col("window_start") + width).alias("end"))
    )
    source = lambda: feed(details.withColumn("__day", F.to_date("ts")), ["__day", "sku_id"]).drop("__day")
    by_province = run(joins.province_order_emissions(source(), Inputs.DETAIL_ORDER, "1 day"), "province")
    same(
        by_province.select(*bounds(10), "province_id", "order_id", "id", "sign", "at_ts", "order_count", F.col("order_amount").cast("decimal(16,2)")),
        trade.province_order_emissions(details, Inputs.DETAIL_ORDER, day),
    )
    by_sku = run(joins.sku_order_emissions(source(), Inputs.DETAIL_ORDER, "1 day"), "sku")
    amounts = [F.col(n).cast("decimal(16,2)") for n in trade.SKU_AMOUNTS.values()]
    same(by_sku.select(*bounds(5), "sku_id", "id", "sign", "at_ts", *amounts), trade.sku_order_emissions(details, Inputs.DETAIL_ORDER, day))


def test_first_of_day_windows_stream(inputs, feed, run, same):
    """One query each, state and window; a row far in the future closes the last window."""
    views = logs.page_views(inputs.page_log())
    columns = ["mid", "uid", "page_id", "last_page_id", "ts", "seq"]
    flat = views.select(*columns).where(F.col("seq") < 500)
    end = flat.limit(1).select(
        F.lit("end").alias("mid"), F.lit("end").alias("uid"), F.lit("home").alias("page_id"), F.lit("login").alias("last_page_id"),
        F.lit("2030-01-01").cast("timestamp").alias("ts"), F.lit(10**9).cast("bigint").alias("seq"),
    )
    source = lambda: feed(flat.unionByName(end), ["ts", "seq"])
    past = lambda df: df.where("stt < '2029'")
    same(past(run(windows.home_detail_uv_window(source(), "0 seconds"), "home")), traffic.home_detail_uv_window(flat))
    same(past(run(windows.user_login_window(source(), "0 seconds"), "login")), traffic.user_login_window(flat))
    adds = facts.cart_adds(inputs.cart_changes()).select("user_id", "ts").where("ts < '1996-01-01'")
    last = adds.limit(1).select(F.lit("end").alias("user_id"), F.lit("2030-01-01").cast("timestamp").alias("ts"))
    got = run(windows.cart_uu_window(feed(adds.unionByName(last), ["ts"]), "0 seconds"), "cart")
    same(past(got), traffic.cart_uu_window(adds))


def test_last_emission_of_a_window_is_its_total(inputs, same):
    details = inputs.detail_of_orders().drop("user_id").dropDuplicates()
    emitted = trade.province_order_emissions(details, Inputs.DETAIL_ORDER, times.seconds_slice(F.col("ts"), DAY))
    net = emitted.groupBy("stt", "edt", "cur_date", "province_id").agg(F.sum("sign").alias("versions"), F.count("*").alias("n"))
    total = trade.province_order_window(details, inputs.provinces(), Inputs.DETAIL_ORDER)
    assert net.count() == total.count()
    single = net.where("n = 1").join(emitted, ["stt", "edt", "cur_date", "province_id"])
    same(
        single.select("stt", "edt", "cur_date", "province_id", "order_count", "order_amount"),
        total.join(net.where("n = 1"), ["stt", "edt", "cur_date", "province_id"]).select("stt", "edt", "cur_date", "province_id", "order_count", "order_amount"),
    )


def test_device_running_streams(inputs, feed, run, same):
    base = logs.device_search_base(inputs.page_log())
    base = base.where(F.col("seq") < 400)
    flat = base.select("uid", "ts", "seq", "device.os", "device.ch", "device.md", "device.ba", "search_item")
    batch = labels.user_device_running(base, times.seconds_slice(F.col("ts"), DAY))
    same(run(joins.user_device_running(feed(flat, ["ts", "seq"])), "devices"), batch)


def test_facts_are_routed_by_a_second_stream(inputs, feed, run, same):
    changes = inputs.changes().where("ts_ms < 860000000000")
    history = inputs.config_history()
    batch = cdc.route_fact_as_of(changes, history, times.seconds_slice(F.col("ts"), DAY))
    timed = changes.withColumn("ts", F.timestamp_millis("ts_ms")).select("op", "source", "after", "ts", F.lit(1).alias("kind"))
    entries = history.select("op", "ts", "source_table", "sink_table", "sink_columns", F.lit(0).alias("kind"))
    both = feed(timed.unionByName(entries, allowMissingColumns=True), ["ts", "kind"])
    streamed = joins.route_facts(both.where("kind = 1").drop("kind"), both.where("kind = 0").select(*entries.columns[:-1]))
    got = run(streamed, "routed")
    plain = lambda df: df.withColumn("payload", keys.map_text(F.col("payload")))
    same(plain(got), plain(batch))
    assert batch.select("sink_table").distinct().count() > 4


def test_label_chain_streams(inputs, feed, run, same):
    few = lambda df: df.where(F.col("uid").cast("bigint") % 5 == 1)
    devices, orders, profiles = few(batch_plans._searched(inputs)), few(batch_plans._order_scores(inputs)), few(batch_plans._profiles(inputs))
    whole = labels.user_label(labels.label_scores_join(devices, orders), profiles)
    assert not whole.isEmpty()
    streamed = jobs.user_label(feed(devices, ["ts"], 2), feed(orders, ["ts"], 2), feed(profiles, ["ts"], 2))
    same(run(streamed, "labels"), whole)


def test_hot_query_changes_stream(inputs, feed, run, same):
    searches = search.search_log_clean(inputs.search_lines()).select("query", "ts").where(F.col("query").isNotNull())
    end = searches.limit(1).select("query", F.lit("2030-01-01").cast("timestamp").alias("ts"))
    batch = search.hot_query_changes(search.query_count_window(searches), 5)
    got = run(tops.hot_query_changes(feed(searches.unionByName(end), ["ts"]), 5, delay="0 seconds"), "tops")
    same(got.where("window_end < 1800000000000"), batch)
    assert batch.count() > 20
