"""Each streaming form, fed in several micro-batches, gives the rows of its batch form."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from millrace.functions import times
from millrace.operators import cdc, customers, dedup, facts, labels, logs, moderation, search, traffic
from millrace.plans.views import Inputs
from millrace.sources.sinks import KeyedTable
from millrace.streaming import jobs, state


def views(inputs):
    return logs.page_views(inputs.page_log())


def test_newcomer(inputs, feed, run, same):
    flat = inputs.page_log().select(
        "common.mid", "common.is_new", times.millis_to_timestamp(F.col("ts")).alias("ts"), "seq"
    )
    batch = logs.fix_is_new(inputs.page_log()).select("common.mid", "common.is_new", "seq")
    streamed = run(state.newcomer(feed(flat, ["ts", "seq"])), "newcomer")
    same(streamed.select("mid", "is_new", "seq"), batch)


def test_first_of_day(inputs, feed, run, same):
    flat = views(inputs).select("mid", "ts", "seq")
    batch = traffic.uv_flag(views(inputs)).select("mid", "ts", "seq", "uv_ct")
    same(run(state.first_of_day(feed(flat, ["ts", "seq"]), "mid"), "uv"), batch)


def test_traffic_window(spark, inputs, feed, run, tmp_path, same):
    """Two chained streams: flags into a folder, windows over that folder."""
    flat = views(inputs).select("mid", "ts", "seq", *traffic.TRAFFIC_KEYS, "last_page_id", "during_time")
    flagged = run(state.first_of_day(feed(flat, ["ts", "seq"]), "mid"), "flags")
    table = KeyedTable(str(tmp_path / "traffic"), ("stt", "edt", "cur_date", *traffic.TRAFFIC_KEYS), ("pv_ct",))
    jobs.run_available(
        jobs.traffic_window(feed(flagged, ["ts", "seq"])),
        "traffic",
        jobs.upsert_into(table),
        "update",
        location=str(tmp_path / "cp-traffic"),
    )
    same(table.read(spark), traffic.traffic_page_view_window(views(inputs)))


def test_login(inputs, feed, run, same):
    source = logs.logins(views(inputs)).select("uid", "ts", "seq")
    streamed = run(state.login(feed(source, ["ts", "seq"])), "login")
    windowed = streamed.groupBy(F.window("ts", "1 second")).agg(
        F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct")
    )
    same(
        windowed.select(*times.window_bounds(F.col("window")), "back_ct", "uu_ct"),
        traffic.user_login_window(views(inputs)),
    )


def test_retract(inputs, feed, run, same):
    columns = ["id", *Inputs.DETAIL_ORDER]
    details = inputs.order_detail().select(*columns)
    batch = dedup.retract_dedup(
        details, "id", Inputs.DETAIL_ORDER, facts.AMOUNTS, times.seconds_slice(F.col("ts"), 86400)
    )
    streamed = run(
        state.retract(feed(details, ["ts", *Inputs.DETAIL_ORDER]), "id", Inputs.DETAIL_ORDER, facts.AMOUNTS),
        "retract",
    )
    same(streamed, batch)


def test_newest_only(spark, inputs, feed, run, same):
    arrivals = inputs.table("orders").select(
        "o_custkey", "o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms")
    )
    batch = dedup.newest_only(arrivals, "o_custkey", "ts_ms", ["o_orderkey"], F.floor(F.col("o_orderkey") / 100).cast("bigint"))
    streamed = run(state.newest_only(feed(arrivals, ["o_orderkey"]), "o_custkey", "ts_ms", ["o_orderkey"]), "newest")
    same(streamed, batch)


def test_customer_segments(inputs, feed, run, same):
    cleaned = customers.clean(inputs.shop_actions())
    streamed = run(state.customer_history(feed(cleaned, ["ts", "seq"])), "history")
    same(customers._events(streamed, customers.is_new_visit(3)), customers.new_visit_events(cleaned, 3))
    same(customers._events(streamed, customers.is_return_visit()), customers.return_visit_events(cleaned))
    same(customers._events(streamed, customers.is_old_customer(3)), customers.old_customer_events(cleaned, 3))


def test_device_rollup(inputs, feed, run, same):
    base = logs.device_search_base(inputs.page_log())
    flat = base.select("uid", "device.os", "device.ch", "device.md", "device.ba", "search_item", "ts", "seq")
    streamed = run(state.device_rollup(feed(flat, ["ts", "seq"])), "rollup")
    last = Window.partitionBy("uid").orderBy(F.desc("pv"))
    final = streamed.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n", "seq")
    same(final, labels.user_device_rollup(base))


def test_log_split(spark, inputs, feed, tmp_path, same):
    raw = inputs.raw_log().select("value", "seq")
    out = str(tmp_path / "split")
    jobs.run_available(
        feed(raw, ["seq"]), "split", jobs.split_log_batch(out), location=str(tmp_path / "cp-split"), wait=120
    )
    log = inputs.page_log()
    good = log.where(~F.col("common.sid").endswith("-97"))
    for name, batch in {
        "err": logs.split_err(good),
        "start": logs.split_start(good).select("seq", "start", "ts"),
        "display": logs.split_display(good),
        "action": logs.split_action(good),
        "page": logs.split_page(good),
    }.items():
        same(spark.read.parquet(f"{out}/{name}").select(*batch.columns), batch)
    assert spark.read.parquet(f"{out}/dirty").count() == log.count() - good.count()


def test_windows_in_update_mode(spark, inputs, feed, tmp_path, same):
    searched = logs.keyword_searches(views(inputs))
    table = KeyedTable(str(tmp_path / "kw"), ("stt", "edt", "cur_date", "keyword"), ("keyword_count",))
    jobs.run_available(
        jobs.keyword_window(feed(searched, ["ts", "seq"])),
        "kw",
        jobs.upsert_into(table),
        "update",
        location=str(tmp_path / "cp-kw"),
    )
    same(table.read(spark), traffic.keyword_window(views(inputs)))

    searches = search.search_log_clean(inputs.search_lines())
    counts = KeyedTable(str(tmp_path / "qc"), ("window", "query"), ("query_count",))
    jobs.run_available(
        jobs.query_count_window(feed(searches, ["ts"])),
        "qc",
        jobs.upsert_into(counts),
        "update",
        location=str(tmp_path / "cp-qc"),
    )
    stored = counts.read(spark)
    same(
        stored.select(
            "query",
            "query_count",
            F.unix_millis("window.start").alias("window_start"),
            F.unix_millis("window.end").alias("window_end"),
        ),
        search.query_count_window(searches),
    )


def test_hot_queries(spark, inputs, feed, tmp_path):
    searches = search.search_log_clean(inputs.search_lines())
    seen = {}

    def keep(batch, batch_id):
        seen[batch_id] = [tuple(r) for r in batch.collect()]

    jobs.run_available(
        jobs.hot_queries(feed(searches, ["ts"])), "hot", keep, "complete", location=str(tmp_path / "cp-hot")
    )
    top = search.hot_query_topn(search.query_count_window(searches)).orderBy("rank")
    assert seen[max(seen)] == [(r["query"], r["query_count"]) for r in top.collect()]


def test_interval_join(inputs, feed, run, same):
    batch = labels.user_profile_interval(inputs.users(), inputs.supplements())
    extra = inputs.supplements().withColumnRenamed("ts", "sup_ts")
    streamed = jobs.interval_join(
        feed(inputs.users(), ["ts"], 2), feed(extra, ["sup_ts"], 2), ["uid"], "ts", "sup_ts", -300, 300
    )
    same(run(streamed, "interval"), batch)


def test_daily_distinct(inputs, feed, run, same):
    adds = facts.cart_adds(inputs.cart_changes()).select("user_id", "ts")
    streamed = run(jobs.daily_distinct(feed(adds, ["ts"]), ["user_id"]), "cart")
    same(
        streamed.select("user_id", F.to_date("day").alias("day")),
        traffic.first_per_day(adds, "user_id").select("user_id", "day"),
    )


def test_keyed_table_repeats_are_harmless(spark, tmp_path, same):
    table = KeyedTable(str(tmp_path / "t"), ("k",), ("v",))
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, v int, x string")
    second = spark.createDataFrame([(1, 3, "d")], "k int, v int, x string")
    for batch, n in ((first, 0), (second, 1), (second, 1), (first, 0)):
        table.write_batch(batch, n)
    expected = spark.createDataFrame([(1, 3, "d"), (2, 1, "c")], "k int, v int, x string")
    same(table.read(spark), expected)
    same(table.rewrite(spark, str(tmp_path / "t2")).read(spark), expected)


def test_event_time(spark):
    df = spark.createDataFrame([(1700000000, None), (1700000000123, None), (None, 5), (None, None)], "a bigint, b bigint")
    out = jobs.with_event_time(df, "a", "3 seconds", fallback="b").select(F.unix_millis("ts")).collect()
    assert sorted(r[0] for r in out) == [5000, 1700000000000, 1700000000123]


def test_two_runs_into_one_table(spark, tmp_path):
    """A second stream starts at batch 0 again and leaves the first one's rows; a repeat replaces its own."""
    from millrace.sources.readers import folder_stream

    table = KeyedTable(str(tmp_path / "table"), ("k",), ("v",))
    for n, rows in enumerate([[("a", 1)], [("b", 2)]]):
        source = str(tmp_path / f"in{n}")
        frame = spark.createDataFrame(rows, "k string, v bigint")
        frame.coalesce(1).write.parquet(source)
        stream = folder_stream(spark, source, frame.schema)
        jobs.run_available(stream, f"run{n}", table.write_batch, location=str(tmp_path / f"cp{n}"))
    assert sorted(tuple(r) for r in table.read(spark).select("k", "v").collect()) == [("a", 1), ("b", 2)]
    merged = table.rewrite(spark, str(tmp_path / "merged"))
    assert merged.read(spark).count() == 2


def test_routing_and_dimensions_equal_their_batch_forms(spark, inputs, feed, tmp_path, same):
    changes = inputs.changes()
    stream = feed(changes.select(*changes.columns), ["ts_ms"])
    routed = str(tmp_path / "routed")
    jobs.run_available(stream, "route", jobs.route_facts(inputs.fact_config, routed), location=str(tmp_path / "cp1"))
    got = spark.read.parquet(routed).select("sink_table", F.array_sort(F.map_entries("payload")).alias("p"), "ts")
    want = cdc.route_fact(changes, inputs.fact_config()).select("sink_table", F.array_sort(F.map_entries("payload")).alias("p"), "ts")
    same(got, want)

    table = KeyedTable(str(tmp_path / "dims"), ("sink_table", "row_key"), ("ts_ms", "payload"))
    stream = feed(changes, ["ts_ms"])
    jobs.run_available(stream, "dims", jobs.upsert_dimensions(inputs.dim_config, table), location=str(tmp_path / "cp2"))
    same(table.read(spark), cdc.dim_latest(changes, inputs.dim_config()))


def test_moderated_stream_equals_batch(spark, inputs, feed, tmp_path, same):
    comments = inputs.comments().where("id LIKE '%-1'")
    words = inputs.words().where("length(word) > 3")
    folder = str(tmp_path / "graded")
    jobs.run_available(feed(comments, ["id"]), "moderate", jobs.moderate(lambda: words, "id", folder), location=str(tmp_path / "cp"))
    want = moderation.comment_moderation(comments, words, "id")
    same(spark.read.parquet(folder).select(*want.columns), want)
