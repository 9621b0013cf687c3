"""Boundaries and the rules where the evident intent was followed."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import keys, profile, texts, times
from millrace.operators import cdc, customers, facts, labels, logs, moderation, records, search, tables, trade, traffic

START = datetime(2024, 1, 1, 12)


def one(df):
    (row,) = df.collect()
    return tuple(row)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


# --- functions -----------------------------------------------------------------------------------


def test_time_slots(spark):
    hours = [0, 5, 6, 8, 9, 11, 12, 13, 14, 17, 18, 21, 22, 23]
    got = column(spark, [datetime(2024, 1, 1, h, 59) for h in hours], "timestamp", times.time_slot)
    assert got == ["凌晨"] * 2 + ["早晨"] * 2 + ["上午"] * 2 + ["中午"] * 2 + ["下午"] * 2 + ["晚上"] * 2 + ["夜间"] * 2


def test_zodiac_edges(spark):
    days = [(1, 19), (1, 20), (2, 18), (2, 19), (6, 21), (6, 22), (12, 21), (12, 22), (12, 31)]
    got = column(spark, [date(2000, m, d) for m, d in days], "date", profile.zodiac_sign)
    assert got == ["摩羯座", "水瓶座", "水瓶座", "双鱼座", "双子座", "巨蟹座", "射手座", "摩羯座", "摩羯座"]


def test_age_and_decade(spark):
    as_of = F.lit("2024-02-01").cast("date")
    births = [date(2000, 2, 1), date(2000, 2, 2), date(2000, 2, 29), date(1999, 12, 31)]
    assert column(spark, births, "date", lambda b: profile.whole_years(b, as_of)) == [24, 23, 23, 24]
    assert column(spark, births, "date", profile.birth_decade) == [2000, 2000, 2000, 1990]


def test_epoch_units(spark):
    values = ["9999999999", "10000000000", "1700000000000", "x", None]
    assert column(spark, values, "string", times.epoch_millis) == [9999999999000, 10000000000, 1700000000000, None, None]


def test_hash_bucket(spark):
    # md5("a") ends in 661, md5("") in 27e
    assert column(spark, ["a", ""], "string", lambda c: keys.hash_bucket(c, 128)) == [f"{0x661 % 128:04d}", f"{0x27E % 128:04d}"]


def test_row_keys(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    x, y = F.col("x"), F.col("y")
    joined, hashed = one(df.select(keys.row_key(x, y), keys.row_key(x, y, hash_key=True)))
    assert joined == "a_1" and hashed == one(df.select(F.md5(F.lit("a_1"))))[0]
    parts = one(df.select(keys.row_key(x, y, separator="", hash_fields=True)))[0]
    assert len(parts) == 64


def test_clean_characters(spark):
    values = ["abc中文123", "a b", "!?，。", "é", ""]
    assert column(spark, values, "string", texts.is_clean) == [True, False, True, False, False]


def test_last_part(spark):
    values = ["a,b", "a", "a,b,,", ",", ""]
    assert column(spark, values, "string", texts.last_part) == ["b", "a", "b", "", ""]


def test_words(spark):
    assert column(spark, ["Red  widget-2, été!", ""], "string", texts.words) == [["red", "widget", "2", "été"], []]


# --- logs ----------------------------------------------------------------------------------------


def test_dirty_json(spark):
    lines = ['{"ts": 5, "seq": 1}', '{"ts": 5', "not json", "", None]
    parsed = logs.parse_json(spark.createDataFrame([(v,) for v in lines], "value string"), schemas.PAGE_LOG)
    assert [r.dirty for r in parsed.collect()] == [False, True, True, True, True]
    assert [r.ts for r in logs.good_records(parsed).collect()] == [5]
    assert logs.dirty_records(parsed).count() == 4
    assert logs.drop_null_messages(parsed).count() == 4


def test_split_rules(spark):
    schema = schemas.PAGE_LOG
    item = {"item": "1", "item_type": "sku_id", "pos_id": 1, "pos_seq": 1}
    act = {"action_id": "x", "item": "1", "item_type": "sku_id", "ts": 9}
    base = {"common": {"mid": "m", "uid": "u"}, "ts": 7}
    records = [
        {**base, "seq": 1, "page": {"page_id": "home"}, "displays": [item, item], "actions": [act]},
        {**base, "seq": 2, "start": {"entry": "icon"}, "displays": [item], "actions": [act], "err": {"error_code": 3}},
        {**base, "seq": 3, "page": {"page_id": "cart"}, "err": {"error_code": 4}},
    ]
    log = spark.createDataFrame(records, schema)
    assert [r.seq for r in logs.split_err(log).collect()] == [2, 3]
    start = logs.split_start(log)
    assert [r.seq for r in start.collect()] == [2] and "err" not in start.columns
    display = logs.split_display(log)
    assert [r.seq for r in display.collect()] == [1, 1] and "ts" in display.columns
    action = logs.split_action(log)
    assert [r.seq for r in action.collect()] == [1] and "ts" not in action.columns
    assert [r.seq for r in logs.split_page(log).collect()] == [1, 3]


def _log(spark, *records):
    return spark.createDataFrame(
        [
            {"common": {"mid": m, "is_new": n, "uid": "u"}, "ts": int(ts.timestamp() * 1000), "seq": i}
            for i, (m, n, ts) in enumerate(records)
        ],
        schemas.PAGE_LOG,
    )


def test_is_new(spark):
    day = timedelta(days=1)
    log = _log(
        spark,
        ("a", "1", START), ("a", "1", START + timedelta(hours=2)), ("a", "1", START + day), ("a", "0", START + day),
        ("b", "0", START), ("b", "1", START + timedelta(hours=1)),
    )
    fixed = logs.fix_is_new(log).orderBy("seq").select("common.is_new")
    assert [r[0] for r in fixed.collect()] == ["1", "1", "0", "0", "0", "0"]


def test_device_base(spark):
    log = spark.createDataFrame(
        [
            {"common": {"uid": None, "os": "iOS 13.2"}, "page": {"item_type": "keyword", "item": "tv"}, "ts": 1, "seq": 1},
            {"common": {"uid": "", "os": "x"}, "ts": 1, "seq": 2},
            {"common": {"uid": "7", "os": "Android"}, "page": {"item_type": "sku_id", "item": "3"}, "ts": 1, "seq": 3},
        ],
        schemas.PAGE_LOG,
    )
    got = logs.device_search_base(log).orderBy("seq").select("uid", "device.os", "search_item").collect()
    assert [tuple(r) for r in got] == [("-1", "iOS", "tv"), ("7", "Android", None)]


def test_snake_case_json(spark):
    df = spark.createDataFrame([(1, "x")], "curDate int, pvCt string")
    assert one(logs.rows_to_json(df)) == ('{"cur_date":1,"pv_ct":"x"}',)


# --- traffic -------------------------------------------------------------------------------------


def test_back_after_eight_days(spark):
    days = [0, 7, 15, 24]
    views = spark.createDataFrame(
        [("u", None if d else "login", START + timedelta(days=d)) for d in days] + [("", None, START), ("u", "home", START)],
        "uid string, last_page_id string, ts timestamp",
    )
    got = traffic.user_login_window(views).orderBy("stt").select("back_ct", "uu_ct").collect()
    assert [tuple(r) for r in got] == [(0, 1), (0, 1), (1, 1), (1, 1)]


# --- changelog -----------------------------------------------------------------------------------


def _changes(spark, *rows):
    return spark.createDataFrame(
        [(op, before, after, {"db": "shop", "table": table}, ts) for op, before, after, table, ts in rows], schemas.CHANGE
    )


def test_image_of_a_change(spark):
    changes = _changes(spark, ("d", {"id": "1"}, None, "t", 1), ("u", {"id": "1"}, {"id": "2"}, "t", 2))
    assert [r.image["id"] for r in cdc.row_image(changes).orderBy("ts_ms").collect()] == ["1", "2"]
    assert [r.id_ts for r in cdc.flatten(changes).orderBy("ts").collect()] == ["1_1", "2_2"]


def test_routing(spark):
    changes = _changes(
        spark,
        ("c", None, {"id": "1", "name": "x", "secret": "s"}, "a", 5),
        ("d", {"id": "1"}, None, "a", 6),
        ("c", None, {"id": "2"}, "unknown", 7),
    )
    config = spark.createDataFrame([("a", "sink_a", "id,name")], "source_table string, sink_table string, sink_columns string")
    assert one(cdc.route_fact(changes, config)) == ("sink_a", {"id": "1", "name": "x"}, 5)


def test_dimension_changes(spark):
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, name string, brand string")
    changes = spark.createDataFrame(
        [(1, "u", "", 1), (1, "u", "new", 2), (2, "u", "gone", 1), (2, "d", None, 2), (3, "u", "", 1), (4, "u", "added", 1)],
        "id int, op string, name string, at int",
    )
    got = {tuple(r) for r in cdc.dim_apply_changes(table, changes, "id", ["at"]).collect()}
    assert got == {(1, "new", "x"), (3, "c", "z"), (4, "added", None)}


def test_cart_adds(spark):
    image = lambda n: {"id": "1", "user_id": "u", "sku_id": "s", "sku_num": n}
    changes = _changes(
        spark,
        ("r", None, image("3"), "cart_info", 1),
        ("u", image("3"), image("5"), "cart_info", 2),
        ("u", image("5"), image("4"), "cart_info", 3),
        ("c", None, image("9"), "cart_info", 4),
        ("d", image("9"), None, "cart_info", 5),
        ("r", None, image("1"), "other", 6),
    )
    assert [r.sku_num for r in facts.cart_adds(changes).orderBy("ts").collect()] == [3, 2]
    assert [r.sku_num for r in facts.cart_adds(changes, True).orderBy("ts").collect()] == [3, 2, 9]


# --- customers -----------------------------------------------------------------------------------


def _actions(spark, *rows):
    """(days after start, type, amount) of one user in one shop."""
    return customers.clean(
        spark.createDataFrame(
            [
                (str(n), "u", "s", int((START + timedelta(days=d)).timestamp() * 1000), t, 1, True, "c", Decimal(a) if a else None, "o", n)
                for n, (d, t, a) in enumerate(rows)
            ],
            "action_id string, user_id string, shop_id string, ts_ms bigint, action_type string, duration int, liked boolean, "
            "content_id string, amount decimal(16,2), order_id string, seq bigint",
        )
    )


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_new_visit_after_thirty_days(spark):
    actions = _actions(spark, (0, "visit", None), (30, "visit", None), (60.001, "follow", None), (61, "purchase", 5), (200, "visit", None))
    assert seqs(customers.new_visit_events(actions)) == [0, 2]
    assert seqs(customers.return_visit_events(actions)) == [1, 2, 3]


def test_old_customer_within_a_year(spark):
    actions = _actions(spark, (0, "purchase", 5), (365, "visit", None), (365.001, "visit", None), (366, "purchase", 5), (367, "visit", None))
    assert seqs(customers.old_customer_events(actions)) == [1, 4]


def test_interaction_rule_and_reasons(spark):
    base = ("u", "s", 1, "interact")
    rows = [
        ("1", *base, 2, True, "c", None, None, 1),
        ("2", *base, 3, True, "c", None, None, 2),
        ("3", *base, 2, False, "c", None, None, 3),
        ("4", *base, None, True, "c", None, None, 4),
        ("5", "u", "s", 1, "purchase", None, None, None, None, "o", 5),
        ("6", "u", "s", 1, "dance", None, None, None, None, None, 6),
        ("7", None, "s", 1, "visit", None, None, None, None, None, 7),
        ("8", "u", "s", 0, "visit", None, None, None, None, None, 8),
        ("9", "u", "s", 1, None, None, None, None, None, None, 9),
    ]
    actions = spark.createDataFrame(
        rows,
        "action_id string, user_id string, shop_id string, ts_ms bigint, action_type string, duration int, liked boolean, "
        "content_id string, amount decimal(16,2), order_id string, seq bigint",
    )
    assert [r.action_id for r in customers.clean(actions).collect()] == ["1"]
    reasons = {r.action_id: r.invalid_reason for r in customers.invalid(actions).collect()}
    assert reasons == {
        "2": "interaction does not count",
        "3": "interaction does not count",
        "4": "missing interaction field",
        "5": "missing payment field",
        "6": "unknown action type",
        "7": "missing core field",
        "8": "missing core field",
        "9": "missing core field",
    }


@pytest.mark.parametrize("amount,count,expected", [(5000, 3, False), (5000.01, 1, True), (1, 4, True)])
def test_member_rule(spark, amount, count, expected):
    df = spark.createDataFrame([(Decimal(str(amount)), count)], "a decimal(16,2), n int")
    assert one(df.select(customers.member(F.col("a"), F.col("n"))))[0] is expected


def test_metrics_round_half_up(spark):
    actions = _actions(spark, (0, "purchase", "0.01"), (0.1, "purchase", "0.10"), (0.2, "purchase", "0.11"), (0.3, "visit", None))
    row = customers.old_customer_metrics(customers.old_customer_events(actions)).collect()[0]
    assert (row.revisit_count, row.repurchase_count, row.non_repurchase_count) == (3, 2, 1)
    assert row.payment_amount == Decimal("0.21") and row.avg_price == Decimal("0.11")


# --- search --------------------------------------------------------------------------------------


def test_search_lines(spark):
    lines = ["1,tv,2,shop,5,a", "0,tv,2,shop,5,a", "1,,2,shop,5,a", "1,tv,x,shop,5,a", "1,tv,2,shop,y,a", "1,tv,2,shop", "1,tv,2,shop,5,"]
    got = search.search_log_clean(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert [(r.query_id, r.query, r.doc_id, r.title, r.timestamp, r.type) for r in got] == [(1, "tv", 2, "shop", 5, "a")]


def test_top_n_ties(spark):
    counts = spark.createDataFrame([("b", 2, 1), ("a", 2, 1), ("c", 1, 1), ("c", 2, 2)], "query string, query_count bigint, window_end bigint")
    got = search.hot_query_topn(counts, 2).orderBy("rank").collect()
    assert [(r.query, r.query_count, r.rank) for r in got] == [("c", 3, 1), ("a", 2, 2)]


# --- labels --------------------------------------------------------------------------------------


def test_amount_bands(spark):
    values = [Decimal(v) for v in ("999.99", "1000", "3999.99", "4000")]
    got = column(spark, values, "decimal(16,2)", labels.spending_power)
    assert got == ["低消费", "中消费", "中消费", "高消费"]


def test_scores_round_half_up(spark):
    df = spark.createDataFrame([("低消费",), (None,), ("?",)], "spending_pow string")
    scored = labels._scored(df, "amount", F.col("spending_pow"), labels.AMOUNT, labels.WEIGHTS["amount"])
    got = [tuple(r)[1:] for r in scored.collect()]
    assert got[0] == tuple(Decimal(v) for v in ("0.120", "0.090", "0.060", "0.045", "0.030", "0.015"))
    assert got[1] == got[2] == (None,) * 6


def test_brand_and_category_groups(spark):
    df = spark.createDataFrame([("TCL", "数码"), ("小米", "母婴"), ("?", "?"), ("", None)], "tname string, b1_name string")
    got = labels.score_category(labels.score_brand(df)).select("brand_18_24", "category_18_24").collect()
    assert [tuple(r) for r in got] == [
        (Decimal("0.040"), Decimal("0.270")),
        (Decimal("0.180"), Decimal("0.060")),
        (Decimal("0.020"), Decimal("0.030")),
        (None, None),
    ]


def test_ties_go_to_the_youngest(spark):
    sums = {f"sum_{b}": Decimal("0.5") if b in ("25_29", "40_49") else Decimal("0.1") for b in labels.BUCKETS}
    df = spark.createDataFrame([tuple(sums.values())], ", ".join(f"{c} decimal(6,3)" for c in sums))
    row = labels.label_max_bucket(df).collect()[0]
    assert (row.best_bucket, row.best_score) == ("25_29", Decimal("0.500"))


def test_profile_defaults(spark):
    df = spark.createDataFrame(
        [("1", "n", "1", "l", "p", "e", None, None, START), ("", "n", "1", "l", "p", "e", "M", 0, START)],
        "uid string, uname string, user_level string, login_name string, phone_num string, email string, gender string, birthday int, ts timestamp",
    )
    row = labels.user_profile(df, F.lit("2024-02-01").cast("date")).collect()
    assert [(r.uid, r.gender, r.age, r.zodiac_sign) for r in row] == [("1", "home", None, None)]


def test_merge_labels(spark):
    left = spark.createDataFrame([(1, "a", "b")], "uid int, x string, y string")
    right = spark.createDataFrame([(1, "c", "d")], "uid int, y string, z string")
    assert one(labels.merge_labels(left, right, "uid").select("uid", "x", "y", "z")) == (1, "a", "c", "d")


# --- moderation ----------------------------------------------------------------------------------


def test_first_level_wins(spark):
    words = moderation.word_table(spark.createDataFrame([("bad",), ("worse",)], "word string"))
    comments = spark.createDataFrame(
        [(1, "some worse thing,bad"), (2, "worse and bad,fine"), (3, "all fine"), (4, "")], "id bigint, msg string"
    )
    got = moderation.comment_moderation(comments, words, "id").orderBy("id").collect()
    assert [(r.is_violation, r.violation_grade, r.violation_msg) for r in got] == [
        (1, "P0", "bad"),
        (0, "P1", "bad,worse"),
        (0, "", ""),
        (0, "", ""),
    ]


# --- joins over dimensions and reports -----------------------------------------------------------


def test_missing_dimensions_keep_the_row(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    out = trade.sku_dim_chain(
        frame([("1",), ("9",)], "sku_id string"),
        frame([("1", "n", "10", "20", "30")], "id string, sku_name string, spu_id string, tm_id string, category3_id string"),
        frame([("10", "spu")], "id string, spu_name string"),
        frame([], "id string, tm_name string"),
        frame([("30", "c3", "40")], "id string, name string, category2_id string"),
        frame([("40", "c2", "50")], "id string, name string, category1_id string"),
        frame([], "id string, name string"),
    )
    got = {r.sku_id: (r.sku_name, r.spu_name, r.trademark_name, r.category1_id, r.category1_name) for r in out.collect()}
    assert got == {"1": ("n", "spu", None, "50", None), "9": (None,) * 5}


def test_comment_dictionary_default(spark):
    comments = spark.createDataFrame([("1", "A"), ("2", "?")], "id string, appraise string")
    dictionary = spark.createDataFrame([("A", "good")], "code string, n string").select(
        F.md5("code").alias("dic_code"), F.struct(F.col("n").alias("dic_name")).alias("info")
    )
    left = facts.comment_dic_left(comments, dictionary).orderBy("id").collect()
    assert [r.dic_name for r in left] == ["good", "N/A"]
    assert facts.comment_dic(comments, dictionary).count() == 1


def test_filled_days(spark):
    metric = spark.createDataFrame([("a", date(2024, 1, 1), 3), ("a", date(2024, 1, 4), 5)], "k string, day date, n int")
    got = tables.daily_metric_filled(metric, "day", ["k"], ["n"]).orderBy("day").collect()
    assert [(r.day.day, r.n) for r in got] == [(1, 3), (2, 0), (3, 0), (4, 5)]


# --- changelog records ---------------------------------------------------------------------------


def test_payment_and_refund_transitions(spark):
    pay = lambda status: {"order_id": "1", "payment_type": "1101", "callback_time": "5000", "payment_status": status}
    back = lambda status: {"id": "9", "order_id": "1", "sku_id": "2", "total_amount": "3.50", "refund_status": status}
    changes = _changes(
        spark,
        ("u", pay("1601"), pay("1602"), "payment_info", 1),
        ("c", None, pay("1602"), "payment_info", 2),
        ("u", back("0701"), back("1602"), "refund_payment", 3),
        ("u", {}, back("1602"), "refund_payment", 4),
        ("u", back("0701"), back("0705"), "order_refund_info", 5),
        ("c", None, back("0701"), "order_refund_info", 6),
        ("u", {"order_status": "1005"}, {"id": "1", "order_status": "1006"}, "order_info", 7),
        ("u", {"order_status": "1002"}, {"id": "1", "order_status": "1005"}, "order_info", 8),
    )
    assert [r.order_id for r in records.payment_records(changes).collect()] == ["1"]
    paid_back = records.refund_payment_records(changes).collect()
    assert [(r.id, r.total_amount) for r in paid_back] == [("9", Decimal("3.50"))]
    assert records.refund_request_records(changes).count() == 2
    assert records.refund_request_records(changes, granted_only=True).count() == 1
    assert [r.status for r in records.refunded_orders(changes).collect()] == ["1006"]
    assert [r.status for r in records.refunding_orders(changes).collect()] == ["1005"]


def test_detail_record_amounts(spark):
    after = {"id": "1", "sku_num": "3", "order_price": "1.25", "split_coupon_amount": "0.10", "split_total_amount": "x"}
    row = records.order_detail_records(_changes(spark, ("r", None, after, "order_detail", 5))).collect()[0]
    assert (row.split_original_amount, row.split_coupon_amount, row.split_total_amount) == (Decimal("3.75"), Decimal("0.10"), None)


def test_other_records(spark):
    changes = _changes(
        spark,
        ("r", None, {"id": "7", "name": "n", "birthday": "3000"}, "user_info", 1),
        ("r", None, {"id": "", "name": "n"}, "user_info", 1),
        ("r", None, {"uid": "7", "height": "170"}, "user_info_sup_msg", 1),
        ("d", {"id": "1", "comment_txt": "old"}, None, "comment_info", 1),
        ("r", None, {"order_detail_id": "1", "activity_id": "a", "activity_rule_id": "r"}, "order_detail_activity", 1),
        ("r", None, {"order_detail_id": "1", "coupon_id": "c"}, "order_detail_coupon", 1),
    )
    assert [(r.uid, r.gender, r.birthday) for r in records.user_records(changes).collect()] == [("7", "home", 3000)]
    assert [r.height for r in records.supplement_records(changes).collect()] == ["170"]
    assert [(r.op, r.msg) for r in records.comment_records(changes).collect()] == [("d", "old")]
    assert records.activity_records(changes).count() == records.coupon_records(changes).count() == 1


def test_letters(spark):
    assert column(spark, ["abc", "É", ""], "string", texts.first_upper) == ["Abc", "É", ""]
    assert column(spark, ["Abc", "", "X"], "string", texts.first_lower) == ["abc", "", "x"]


def test_goods_log_labels_are_the_sixth_field(spark):
    goods = search.parse_goods_log(spark.createDataFrame([("3,shop,5,tv,99,hot",)], "value string"))
    row = search.search_records(goods).collect()[0]
    assert (row.query_id, row.query, row.doc_id, row.title, row.timestamp, row.type) == (3, "tv", 5, "shop", 99, "hot")


def test_equal_offsets_in_two_partitions(spark):
    """Positions of two partitions repeat; no view is doubled and each device has one first view a day."""
    from millrace.sources.readers import position

    rows = [(0, 7, "a"), (1, 7, "a"), (1, 7, "b")]
    raw = spark.createDataFrame(rows, "partition int, offset long, mid string")
    assert raw.select(position("partition", "offset")).distinct().count() == 2
    views = raw.select("mid", position("partition", "offset").alias("seq"), F.lit("2024-01-01 10:00:00").cast("timestamp").alias("ts"), F.lit(None).cast("string").alias("last_page_id"))
    flags = traffic.uv_flag(views).collect()
    assert len(flags) == 3 and sum(r.uv_ct for r in flags) == 2
    same_position = traffic.uv_flag(views.withColumn("seq", F.lit(7).cast("bigint"))).where("mid = 'b'").collect()
    assert [r.uv_ct for r in same_position] == [1]


def test_a_delete_and_an_update_in_one_millisecond(spark):
    one = "struct<op:string,before:map<string,string>,after:map<string,string>,source:map<string,string>,ts_ms:bigint,seq:bigint>"
    source = {"db": "d", "table": "t"}
    rows = [("u", {"id": "1"}, {"id": "1", "x": "z"}, source, 5, 10), ("d", {"id": "1"}, None, source, 5, 11)]
    changes = spark.createDataFrame(rows, one)
    assert [r.op for r in cdc.audit_latest(changes).collect()] == ["d"]
    assert [r.op for r in cdc.audit_latest(changes.drop("seq")).collect()] == ["d"]
    turned = changes.withColumn("seq", 20 - F.col("seq"))
    assert [r.op for r in cdc.audit_latest(turned).collect()] == ["u"]


def test_an_order_in_two_versions_does_not_double_its_details(spark):
    order = spark.createDataFrame([("o", "u1", "p1", "2024-01-01"), ("o", "u2", "p2", "2024-01-02")], "id string, user_id string, province_id string, ts string")
    assert [tuple(r) for r in facts.latest_orders(order).collect()] == [("o", "u2", "p2")]


def test_malformed_changes_have_an_output(spark):
    from millrace import schemas
    from millrace.sources import readers

    good = '{"op":"c","before":null,"after":{"id":"1"},"source":{"db":"d","table":"t"},"ts_ms":1}'
    values = spark.createDataFrame([(good, 1), ("{broken", 2), (None, 3)], "value string, seq bigint")
    changes = readers.changelog(values)
    assert [(r.op, r.seq) for r in changes.collect()] == [("c", 1)]
    assert [r.seq for r in readers.malformed(values, schemas.CHANGE).collect()] == [2]


def test_rows_without_a_time_have_an_output(spark):
    from millrace.streaming import jobs

    rows = spark.createDataFrame([(1, "1704067200000"), (2, None), (3, "x")], "n int, at string")
    assert [r.n for r in jobs.without_event_time(rows, "at").collect()] == [2, 3]
