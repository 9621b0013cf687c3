"""The registered queries as SQL for another engine, over the same tables.

``VIEWS`` states the inputs of :mod:`millrace.plans.views`; ``SQL`` the queries. The SQL is written
from the rules (window functions over whole keys, plain joins, correlated conditions), not from the
Spark plans, so that agreement means something.
"""

from __future__ import annotations

import re

from millrace.functions.texts import CLEAN_CHARACTERS
from millrace.plans import score_values as labels
from millrace.plans.batch import BRAND_GROUPS, CATEGORY_GROUPS
from millrace.plans.score_values import TIME_SLOTS, ZODIAC
from millrace.plans.views import PROFILE_DAY

STAMP = "'%Y-%m-%d %H:%M:%S.%g'"
SECOND = "'%Y-%m-%d %H:%M:%S'"

VIEWS: dict[str, str] = {
    "v_events": """
        SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms, date_trunc('milliseconds', ts) AS ts, user_id, event_type,
               value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
        FROM events""",
    "v_log": """
        SELECT e.*, CAST(e.user_id AS VARCHAR) AS uid, c_nationkey, c_mktsegment, p_name,
               CAST(c_nationkey AS VARCHAR) AS ar, 'ba' || (k % 4) AS ba, c_mktsegment AS ch,
               CASE WHEN k % 4 = 0 THEN '1' ELSE '0' END AS is_new, 'md' || (k % 7) AS md,
               CASE WHEN e.user_id % 2 = 0 THEN 'iOS 13' ELSE 'Android 12' END AS os,
               'v' || (k % 3) AS vc,
               CASE k % 5 WHEN 0 THEN 'home' WHEN 1 THEN 'good_detail' WHEN 2 THEN 'good_list'
                          WHEN 3 THEN 'cart' ELSE 'order' END AS page_id,
               CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' ELSE '' END AS last_page_id,
               CASE WHEN k % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
               CASE WHEN k % 2 = 0 THEN p_name ELSE CAST(k AS VARCHAR) END AS item,
               CAST(round(value * 100) AS BIGINT) AS during_time,
               CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END AS n_actions
        FROM v_events e JOIN customer ON e.user_id = c_custkey JOIN part ON k = p_partkey""",
    "v_pages": "SELECT * FROM v_log WHERE event_type <> 'signup'",
    "v_device": """
        SELECT seq, uid, ts, split_part(os, ' ', 1) AS os, ch, md, ba,
               CASE WHEN event_type <> 'signup' AND item_type = 'keyword' THEN item ELSE '' END AS search_item
        FROM v_log""",
    "v_actions": """
        SELECT seq, ts, ts_ms, CAST(seq AS VARCHAR) AS action_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST(seq % 3 AS VARCHAR) AS shop_id, strftime(ts, '%Y-%m-%d') AS stat_date, event_type,
               k % 5 AS duration, k % 2 = 0 AS liked, 'c' || k AS content_id,
               CAST(CAST(value AS DECIMAL(16,2)) * 10 AS DECIMAL(16,2)) AS raw_amount
        FROM v_events""",
    "v_clean": """
        SELECT seq, ts, action_id, user_id, shop_id, stat_date,
               CASE event_type WHEN 'view' THEN 'VISIT' WHEN 'click' THEN 'INTERACTION'
                               WHEN 'purchase' THEN 'PAYMENT' ELSE 'FOLLOW' END AS action_type,
               CASE WHEN event_type = 'purchase' THEN raw_amount ELSE 0 END AS amount,
               CASE event_type WHEN 'click' THEN content_id WHEN 'purchase' THEN action_id ELSE '' END AS related_id
        FROM v_actions
        WHERE event_type IN ('view', 'purchase', 'signup')
           OR (event_type = 'click' AND duration < 3 AND liked)""",
    "v_history": """
        SELECT *,
               coalesce(sum(CASE WHEN action_type = 'PAYMENT' THEN 1 ELSE 0 END) OVER before_me, 0) AS prior_purchases,
               max(ts) OVER before_me AS last_ts,
               max(CASE WHEN action_type = 'PAYMENT' THEN ts END) OVER before_me AS last_purchase,
               max(CASE WHEN action_type = 'FOLLOW' THEN 1 ELSE 0 END) OVER with_me AS followed,
               sum(CASE WHEN action_type = 'PAYMENT' THEN 1 ELSE 0 END) OVER with_me AS total_count,
               sum(amount) OVER with_me AS total_amount
        FROM v_clean
        WINDOW before_me AS (PARTITION BY shop_id, user_id ORDER BY ts, seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               with_me AS (PARTITION BY shop_id, user_id ORDER BY ts, seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "v_lines": """
        SELECT concat_ws(',', seq + 1, p_name, CASE WHEN event_type = 'error' THEN 'x' ELSE CAST(k AS VARCHAR) END,
                         'title ' || k, ts_ms, event_type) AS line
        FROM v_events JOIN part ON k = p_partkey""",
    "v_search": """
        SELECT TRY_CAST(split_part(line, ',', 1) AS INTEGER) AS query_id, split_part(line, ',', 2) AS query,
               TRY_CAST(split_part(line, ',', 3) AS INTEGER) AS doc_id, split_part(line, ',', 4) AS title,
               TRY_CAST(split_part(line, ',', 5) AS BIGINT) AS "timestamp", split_part(line, ',', 6) AS "type"
        FROM v_lines""",
    "v_search_ok": """
        SELECT *, make_timestamp("timestamp" * 1000) AS ts FROM v_search
        WHERE query_id > 0 AND doc_id > 0 AND query <> '' AND "timestamp" IS NOT NULL AND "type" <> ''""",
    "v_query_count": """
        SELECT query, count(*) AS query_count, epoch_us(time_bucket(INTERVAL '3 seconds', ts)) // 1000 AS window_start,
               epoch_ms(time_bucket(INTERVAL '3 seconds', ts)) + 3000 AS window_end
        FROM v_search_ok GROUP BY query, time_bucket(INTERVAL '3 seconds', ts)""",
    "v_detail0": """
        SELECT l_orderkey, l_linenumber, concat_ws('-', l_orderkey, l_linenumber) AS id,
               CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
               'sku-' || l_partkey AS sku_name, CAST(l_quantity AS BIGINT) AS sku_num,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS split_original_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS split_activity_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS split_coupon_amount,
               l_shipdate AS ts
        FROM lineitem""",
    "v_detail": """
        SELECT *, split_original_amount - split_activity_amount - split_coupon_amount AS split_total_amount
        FROM v_detail0""",
    "v_order": """
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(c_nationkey AS VARCHAR) AS province_id, c_name AS consignee,
               CAST(CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 50) // 100 AS DECIMAL(14,0)) * 0.01 AS DECIMAL(16,2)) AS total_amount,
               o_orderstatus AS status, o_orderdate AS ts
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_signed": """
        SELECT d.*, 1 AS sign FROM v_detail d
        UNION ALL
        SELECT * EXCLUDE (next_ts), -1 AS sign FROM (
            SELECT d.*, lead(ts) OVER (PARTITION BY id ORDER BY ts, sku_id, sku_num, split_original_amount,
                split_activity_amount, split_coupon_amount, split_total_amount) AS next_ts
            FROM v_detail d) WHERE next_ts IS NOT NULL""",
    "v_activity": """
        SELECT order_detail_id, activity_id, activity_rule_id FROM (
            SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_detail_id, 'act-' || (l_suppkey % 10) AS activity_id,
                   'rule-' || CAST(round(l_discount * 100) AS INTEGER) AS activity_rule_id, l_shipdate AS ts
            FROM lineitem WHERE l_discount > 0)
        QUALIFY row_number() OVER (PARTITION BY order_detail_id ORDER BY ts DESC, activity_id DESC, activity_rule_id DESC) = 1""",
    "v_coupon": """
        SELECT order_detail_id, coupon_id FROM (
            SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_detail_id,
                   'cou-' || CAST(round(l_tax * 100) AS INTEGER) AS coupon_id, l_shipdate AS ts
            FROM lineitem WHERE l_tax > 0)
        QUALIFY row_number() OVER (PARTITION BY order_detail_id ORDER BY ts DESC, coupon_id DESC) = 1""",
    "v_wide": """
        SELECT d.id, d.order_id, o.user_id, d.sku_id, d.sku_name, o.province_id,
               coalesce(activity_id, '') AS activity_id, coalesce(activity_rule_id, '') AS activity_rule_id,
               coalesce(coupon_id, '') AS coupon_id, strftime(d.ts, '%Y-%m-%d') AS date_id, sku_num,
               split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, d.ts
        FROM v_detail d JOIN v_order o ON d.order_id = o.id
        LEFT JOIN v_activity a ON a.order_detail_id = d.id
        LEFT JOIN v_coupon c ON c.order_detail_id = d.id""",
    "v_ev_order": """
        SELECT DISTINCT id AS order_id, user_id, province_id, ts,
               strftime(ts, '%Y%m%d%H%M%S') || '0' || concat_ws('|', id, user_id, province_id) AS at
        FROM v_order""",
    "v_ev_detail": """
        SELECT DISTINCT id, order_id, sku_id, sku_num, split_total_amount, ts,
               strftime(ts, '%Y%m%d%H%M%S') || '1' || concat_ws('|', id, order_id, sku_id, sku_name, sku_num,
                   split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount) AS at
        FROM v_detail""",
    "v_ev_activity": """
        SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber) AS order_detail_id, 'act-' || (l_suppkey % 10) AS activity_id,
               'rule-' || CAST(round(l_discount * 100) AS INTEGER) AS activity_rule_id, l_shipdate AS ts,
               strftime(l_shipdate, '%Y%m%d%H%M%S') || '2' || activity_id || '|' || activity_rule_id AS at
        FROM lineitem WHERE l_discount > 0""",
    "v_ev_coupon": """
        SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber) AS order_detail_id,
               'cou-' || CAST(round(l_tax * 100) AS INTEGER) AS coupon_id, l_shipdate AS ts,
               strftime(l_shipdate, '%Y%m%d%H%M%S') || '3' || coupon_id AS at
        FROM lineitem WHERE l_tax > 0""",
    "v_sku_version": """
        SELECT CAST(l_partkey AS VARCHAR) AS sku_id, l_shipdate AS ts,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'd' ELSE 'u' END AS op,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS price, CAST(l_suppkey AS VARCHAR) AS supplier
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY op DESC, price DESC, supplier DESC) = 1""",
    "v_log3": """
        SELECT o_orderkey // 1000 AS chunk, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey * 7919 % 100000 + n * 50000 AS seq,
               60000 + (o_orderkey // 1000) * 997 % 50000 + 8000 AS high,
               CASE WHEN n = 2 AND o_orderkey % 50 = 0 THEN 'd' WHEN n = 0 THEN 'c' ELSE 'u' END AS op,
               CASE WHEN op = 'd' THEN '' ELSE ['1001', '1002', '1004'][n + 1] END AS order_status,
               CASE WHEN op = 'd' THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) END AS total_amount
        FROM orders, range(3) r(n)""",
    "v_dic": """
        SELECT md5(code) AS dic_code, lower(code) AS dic_name FROM (
            SELECT o_orderpriority AS code FROM orders UNION SELECT l_returnflag FROM lineitem
            UNION SELECT l_linestatus FROM lineitem)""",
    "v_refund": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_suppkey AS VARCHAR) AS user_id,
               l_returnflag AS refund_type, l_linestatus AS refund_reason_type,
               'reason ' || l_linenumber AS refund_reason_txt, CAST(l_quantity AS BIGINT) AS refund_num,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount, l_shipdate AS ts
        FROM lineitem WHERE l_returnflag = 'R'""",
    "v_parts": """
        SELECT *, p_partkey % 200 AS spu, (p_size - 1) // 5 AS c3, (p_size - 1) // 10 AS c2, (p_size - 1) // 20 AS c1
        FROM part""",
    "v_order_change": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'd'
                    WHEN o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderkey % 2 = 1) THEN 'u' ELSE 'r' END AS op,
               CASE WHEN o_orderstatus = 'F' THEN '1002'
                    WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 1 THEN '1003' ELSE '1001' END AS new_status,
               CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS amount, o_custkey, o_orderdate,
               epoch_ms(o_orderdate) AS ts_ms
        FROM orders""",
    "v_change": """
        SELECT 'order_info' AS table_name, CAST(o_orderkey AS VARCHAR) AS id, op, ts_ms,
               CASE WHEN op IN ('u', 'd') THEN 'id=' || o_orderkey || ',operate_time=' || ts_ms || ',order_status=1001,total_amount='
                    || amount || ',user_id=' || o_custkey ELSE '' END AS before,
               CASE WHEN op <> 'd' THEN 'id=' || o_orderkey || ',operate_time=' || ts_ms || ',order_status=' || new_status || ',total_amount='
                    || amount || ',user_id=' || o_custkey ELSE '' END AS after
        FROM v_order_change
        UNION ALL
        SELECT 'order_detail', concat_ws('-', l_orderkey, l_linenumber), 'r', epoch_ms(l_shipdate), '',
               'id=' || l_orderkey || '-' || l_linenumber || ',order_id=' || l_orderkey || ',sku_id=' || l_partkey
               || ',sku_num=' || CAST(l_quantity AS BIGINT)
        FROM lineitem
        UNION ALL
        SELECT 'user_info', CAST(c_custkey AS VARCHAR), 'r', 0, '', 'id=' || c_custkey || ',name=' || c_name FROM customer""",
    "v_cart": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
               CAST(l_partkey AS VARCHAR) AS sku_id,
               CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) - l_linenumber * 5
                    ELSE CAST(l_quantity AS BIGINT) END AS sku_num, l_shipdate AS ts
        FROM lineitem
        WHERE l_returnflag = 'N' OR (l_returnflag = 'A' AND CAST(l_quantity AS BIGINT) > l_linenumber * 5)""",
    "v_words": """
        SELECT DISTINCT word FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM benchmark)
        WHERE word <> ''""",
    "v_comment": """
        SELECT concat_ws('-', conv_id, turn) AS id, CAST(conv_id AS VARCHAR) AS user_id, CAST(conv_id AS VARCHAR) AS order_id,
               'c-' || conv_id AS consignee, substr('ANRX', length(text) % 4 + 1, 1) AS appraise,
               coalesce([w FOR w IN regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+') IF w <> ''][-1], '') AS last_token,
               text || ',' || last_token AS msg,
               TIMESTAMP '1995-01-01' + to_days(CAST(length(text) % 1000 AS INTEGER)) AS ts
        FROM conversations""",
    "v_last": """
        SELECT *, coalesce(string_split(regexp_replace(msg, ',+$', ''), ',')[-1], '') AS last_word FROM v_comment""",
    "v_graded": """
        SELECT l.*, CASE WHEN b.word IS NOT NULL THEN 1 ELSE 0 END AS is_violation, h.hits
        FROM v_last l LEFT JOIN v_words b ON lower(l.last_word) = b.word
        LEFT JOIN (SELECT id, string_agg(word, ',' ORDER BY word) AS hits
                   FROM v_comment JOIN v_words ON contains(lower(msg), word) GROUP BY id) h ON h.id = l.id""",
    "v_moderated": """
        SELECT *, CASE WHEN is_violation = 1 THEN 'P0' WHEN hits IS NOT NULL THEN 'P1' ELSE '' END AS violation_grade,
               CASE WHEN is_violation = 1 THEN last_word ELSE coalesce(hits, '') END AS violation_msg
        FROM v_graded""",
    "v_label_order": """
        SELECT *, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey * 37 % 43200 AS INTEGER)) AS create_ts FROM v_order""",
    "v_label_detail": """
        SELECT d.* EXCLUDE (ts), TIMESTAMP '2024-01-01'
               + to_minutes(CAST(l_orderkey * 37 % 43200 + l_linenumber - 4 AS INTEGER)) AS detail_ts
        FROM v_detail d""",
    "v_order_detail": """
        SELECT d.order_id, o.user_id AS uid, o.consignee, o.total_amount, o.create_ts, d.id AS detail_id, d.sku_id, d.sku_name,
               d.sku_num, d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, d.detail_ts
        FROM v_label_order o JOIN v_label_detail d ON o.id = d.order_id
        WHERE d.detail_ts BETWEEN o.create_ts - INTERVAL '2 minutes' AND o.create_ts + INTERVAL '2 minutes'""",
    "v_newest_detail": """
        SELECT * EXCLUDE (best) FROM (
            SELECT *, max(create_ts) OVER (PARTITION BY detail_id ORDER BY detail_ts, sku_id, sku_num, split_activity_amount,
                split_coupon_amount, split_total_amount ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
            FROM v_order_detail) WHERE best IS NULL OR create_ts > best""",
    "v_device_window": """
        SELECT uid, w, pv, os, ch, md, ba, search_item, ts FROM (
            SELECT *, time_bucket(INTERVAL '2 minutes', ts) AS w,
                   row_number() OVER (PARTITION BY uid, time_bucket(INTERVAL '2 minutes', ts) ORDER BY ts DESC, seq DESC) AS back,
                   count(*) OVER (PARTITION BY uid ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS pv
            FROM v_device) WHERE back = 1""",
    "v_phrase": """
        SELECT p_name, 'b1-' || min(c3) AS b1, min(c3) AS band FROM v_parts GROUP BY p_name""",
    "v_searched": """
        SELECT d.*, d.os AS judge_os, coalesce({search_name}, '') AS search_category
        FROM v_device_window d LEFT JOIN v_phrase p ON d.search_item = p.p_name""",
    "v_sku_dims": """
        SELECT CAST(p_partkey AS VARCHAR) AS sku_id, 'brand#' || (spu % 25 + 1) AS tname,
               'c1-' || ((spu % 10) // 4) AS b1_name
        FROM v_parts""",
    "v_order_scored": """
        SELECT n.*, s.tname, s.b1_name, {slot} AS pay_time_slot, {power} AS spending_pow
        FROM (SELECT *, create_ts AS slot_ts FROM v_newest_detail) n JOIN v_sku_dims s ON n.sku_id = s.sku_id""",
    "v_label_scores": """
        SELECT s.uid, s.ts, s.pv, s.search_item, s.judge_os, o.detail_id, o.create_ts AS order_ts, o.sku_id, o.b1_name,
               o.pay_time_slot, o.spending_pow, {sums}
        FROM v_searched s JOIN v_order_scored o ON s.uid = o.uid
        WHERE o.create_ts BETWEEN s.ts - INTERVAL '6 hours' AND s.ts + INTERVAL '6 hours'""",
    "v_best": """
        SELECT *, greatest({sum_names}) AS best_score, {best} AS best_bucket FROM v_label_scores""",
    "v_user": """
        SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS uid, c_name AS uname, CAST(c_custkey % 5 AS VARCHAR) AS user_level,
               'login' || c_custkey AS login_name, '1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_num,
               'u' || c_custkey || '@mail.test' AS email,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'home' END AS gender,
               DATE '1960-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER) AS birthday,
               TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey * 211 % 43200 AS INTEGER)) AS ts
        FROM customer""",
    "v_profile": """
        SELECT *, CAST(year(birthday) // 10 * 10 AS BIGINT) AS decade,
               date_sub('year', birthday, DATE '{profile_day}') AS age, {zodiac} AS zodiac_sign
        FROM v_user""",
    "v_profile_sup": """
        SELECT p.*, CAST(150 + s.c_custkey % 50 AS VARCHAR) AS height, CAST(45 + s.c_custkey % 40 AS VARCHAR) AS weight,
               TIMESTAMP '2024-01-01' + to_minutes(CAST(s.c_custkey * 211 % 43200 + s.c_custkey * 7 % 21 - 10 AS INTEGER)) AS sup_ts
        FROM v_profile p JOIN customer s ON p.c_custkey = s.c_custkey
        WHERE sup_ts BETWEEN p.ts - INTERVAL '5 minutes' AND p.ts + INTERVAL '5 minutes'""",
}


def _score_case(label: str, table: dict[str, tuple[float, ...]], weight, i: int, other: tuple[float, ...] | None) -> str:
    """The i-th number of the label's row times the weight, rounded by the other engine."""
    whens = " ".join(
        f"WHEN '{name}' THEN {numbers[i]}" for name, numbers in table.items()
    )
    rest = f"ELSE {other[i]}" if other else ""
    return f"round(CAST(CASE {label} {whens} {rest} END AS DECIMAL(6,4)) * CAST({weight} AS DECIMAL(6,4)), 3)"


def _group_case(value: str, groups: dict[str, list[str]]) -> str:
    whens = " ".join(
        f"WHEN {value} IN ({', '.join(repr(m) for m in members)}) THEN '{name}'" for name, members in groups.items()
    )
    return f"(CASE {whens} ELSE '' END)"


FEATURES = {
    "device": ("judge_os", labels.DEVICE, None),
    "search": ("search_category", labels.SEARCH, labels.SEARCH_OTHER),
    "time": ("pay_time_slot", labels.TIME, None),
    "amount": ("spending_pow", labels.AMOUNT, None),
    "brand": (_group_case("tname", BRAND_GROUPS), labels.BRAND, labels.BRAND_OTHER),
    "category": (_group_case("b1_name", CATEGORY_GROUPS), labels.CATEGORY, labels.CATEGORY_OTHER),
}


_BRANDS = [m for members in labels.BRAND_GROUPS.values() for m in members] + ["无"]
_CATEGORIES = [m for members in labels.CATEGORY_GROUPS.values() for m in members] + ["无"]


def _real(kind: str) -> str:
    value, groups, table, other = {
        "brand": ("tname", labels.BRAND_GROUPS, labels.BRAND, labels.BRAND_OTHER),
        "category": ("b1_name", labels.CATEGORY_GROUPS, labels.CATEGORY, labels.CATEGORY_OTHER),
    }[kind]
    return ", ".join(
        f"CAST({_score_case(_group_case(value, groups), table, labels.WEIGHTS[kind], i, other)} AS DOUBLE) AS {kind}_{b}"
        for i, b in enumerate(labels.BUCKETS)
    )


def _score(feature: str, i: int) -> str:
    label, table, other = FEATURES[feature]
    return _score_case(label, table, labels.WEIGHTS[feature], i, other)


def _scores(feature: str) -> str:
    return ", ".join(
        f"CAST({_score(feature, i)} AS DOUBLE) AS {feature}_{b}" for i, b in enumerate(labels.BUCKETS)
    )


def _slot(ts: str) -> str:
    return "CASE " + " ".join(f"WHEN hour({ts}) < {upper} THEN '{name}'" for name, upper in TIME_SLOTS) + " END"


_LOW, _MIDDLE, _HIGH = labels.AMOUNT
_POWER = (
    f"CASE WHEN total_amount < {labels.AMOUNT_MIDDLE_FROM} THEN '{_LOW}' "
    f"WHEN total_amount < {labels.AMOUNT_HIGH_FROM} THEN '{_MIDDLE}' ELSE '{_HIGH}' END"
)
_SEARCH_NAME = "CASE band % 7 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(labels.SEARCH)) + " END"
_MONTH_DAY = "month(birthday) * 100 + day(birthday)"
_ZODIAC = (
    "CASE " + " ".join(f"WHEN {_MONTH_DAY} <= {last} THEN '{name}'" for name, last in ZODIAC) + f" ELSE '{ZODIAC[0][0]}' END"
)
_SUM_NAMES = ", ".join(f"sum_{b}" for b in labels.BUCKETS)
_SUMS = ", ".join(
    "(" + " + ".join(f"coalesce({_score(f, i)}, 0)" for f in FEATURES) + f") AS sum_{b}"
    for i, b in enumerate(labels.BUCKETS)
)
_BEST = (
    "CASE greatest(" + _SUM_NAMES + ") " + " ".join(f"WHEN sum_{b} THEN '{b}'" for b in labels.BUCKETS) + " END"
)

_FILL = {
    "{search_name}": _SEARCH_NAME,
    "{slot}": _slot("slot_ts"),
    "{power}": _POWER,
    "{sums}": _SUMS,
    "{sum_names}": _SUM_NAMES,
    "{best}": _BEST,
    "{profile_day}": PROFILE_DAY,
    "{zodiac}": _ZODIAC,
}


def _window(width: str, ts: str = "ts", day: str = "%Y-%m-%d") -> str:
    start = f"time_bucket(INTERVAL '{width}', {ts})"
    return (
        f"strftime({start}, {SECOND}) AS stt, strftime({start} + INTERVAL '{width}', {SECOND}) AS edt, "
        f"strftime({start}, '{day}') AS cur_date"
    )


def _stamp(ts: str, name: str | None = None) -> str:
    return f"strftime({ts}, {STAMP}) AS {name or ts.split('.')[-1]}"


def _money(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


_AMOUNTS = ("split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount")

_EVENTS = f"""
    SELECT shop_id, stat_date, user_id, seq, {_stamp("ts")},
           CASE WHEN action_type = 'PAYMENT' THEN 1 ELSE 0 END AS paid_count,
           CASE WHEN action_type = 'PAYMENT' THEN 0 ELSE 1 END AS unpaid_count,
           CAST(amount AS DOUBLE) AS payment_amount, CAST(followed AS BIGINT) AS followed,
           CAST(total_count AS BIGINT) AS total_purchase_count, CAST(total_amount AS DOUBLE) AS total_purchase_amount
    FROM v_history WHERE """


def _new(days: int) -> str:
    return f"(prior_purchases = 0 AND (last_ts IS NULL OR ts - last_ts > INTERVAL '{days} days'))"


_RETURN = "(prior_purchases = 0 AND last_ts IS NOT NULL)"


def _old(days: int) -> str:
    return f"(last_purchase IS NOT NULL AND ts - last_purchase <= INTERVAL '{days} days')"


def _metrics(condition: str, visits: str, paid: str, unpaid: str) -> str:
    return f"""
    SELECT shop_id, stat_date, count(*) AS {visits}, count(*) FILTER (pay) AS {paid}, count(*) FILTER (NOT pay) AS {unpaid},
           CAST(count(*) FILTER (pay) AS DOUBLE) / count(*) AS payment_rate, CAST(sum(amount) AS DOUBLE) AS payment_amount,
           CASE WHEN count(*) FILTER (pay) > 0
                THEN CAST((2 * CAST(sum(amount) * 100 AS BIGINT) + count(*) FILTER (pay)) // (2 * count(*) FILTER (pay)) AS DOUBLE) / 100
                ELSE 0.0::DOUBLE END AS avg_price,
           count(*) FILTER (followed = 1) AS follow_count, count(*) FILTER (member) AS member_count,
           count(DISTINCT user_id) FILTER (followed = 1) AS follow_users,
           count(DISTINCT user_id) FILTER (member) AS member_users
    FROM (SELECT *, action_type = 'PAYMENT' AS pay, total_amount > 5000 OR total_count > 3 AS member
          FROM v_history WHERE {condition})
    GROUP BY shop_id, stat_date"""


_SALES = f"""
    SELECT shop_id, stat_date, sum(amount) AS total_sales,
           coalesce(sum(amount) FILTER ({_new(30)}), 0) AS new_sales,
           coalesce(sum(amount) FILTER ({_RETURN}), 0) AS return_sales,
           coalesce(sum(amount) FILTER ({_old(365)}), 0) AS old_sales
    FROM v_history WHERE action_type = 'PAYMENT' GROUP BY shop_id, stat_date"""

_NEWCOMER = """
    SELECT seq, uid AS mid, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> known THEN '0' ELSE is_new END AS is_new
    FROM (SELECT *, CAST(first_value(ts) OVER w AS DATE) - CASE WHEN first_value(is_new) OVER w = '1' THEN 0 ELSE 1 END AS known
          FROM v_log WINDOW w AS (PARTITION BY uid ORDER BY ts, seq))"""

# Versions of details in their order, and each with the negation of the one before.
_SIGNED = """versions AS ({versions}), placed AS (
            SELECT *, strftime(ts, '%Y%m%d') || md5(id)[1:2] AS place,
                   row_number() OVER (PARTITION BY id ORDER BY ts, sku_id, sku_num, split_original_amount, split_activity_amount,
                       split_coupon_amount, split_total_amount) AS n
            FROM versions
        ), signed AS (
            SELECT *, 1 AS sign, ts AS at_ts FROM placed
            UNION ALL
            SELECT a.* REPLACE (b.place AS place, b.n AS n), -1, b.ts FROM placed a JOIN placed b ON a.id = b.id AND b.n = a.n + 1
        )"""


def _emissions(days: int) -> str:
    """Each join in turn: who meets whom, what is current when, and from when to when nothing was."""
    life = f"INTERVAL '{days} days'"

    def left_join(name: str, rows: str, events: str, columns: str) -> str:
        bare = ", ".join("NULL" for _ in columns.split(", "))
        return f"""
        {name}_met AS (
            SELECT r.*, {columns}, e.at AS e_at, e.ts AS e_ts, lead(e.at) OVER (PARTITION BY r.rid ORDER BY e.at) AS e_next
            FROM {rows} r JOIN {events} e ON e.order_detail_id = r.id AND e.ts BETWEEN r.born_ts - {life} AND r.born_ts + {life}
             AND (r.gone IS NULL OR e.at < r.gone)),
        {name} AS (
            SELECT * EXCLUDE (e_at, e_ts, e_next, rid, born, born_ts, gone), rid || '#' || e_at AS rid, greatest(born, e_at) AS born,
                   greatest(born_ts, e_ts) AS born_ts, least(gone, e_next) AS gone
            FROM {name}_met WHERE e_next IS NULL OR e_next > born
            UNION ALL
            SELECT r.* EXCLUDE (rid, born, born_ts, gone), {bare}, r.rid || '#', r.born, r.born_ts, least(r.gone, f.first)
            FROM {rows} r LEFT JOIN (SELECT rid, min(e_at) AS first FROM {name}_met GROUP BY rid) f ON f.rid = r.rid
            WHERE f.first IS NULL OR f.first > r.born)"""

    return f"""
        WITH placed AS (
            SELECT d.id, d.order_id, o.user_id, d.sku_id, o.province_id, d.sku_num, d.split_total_amount, d.at || '#' || o.at AS rid,
                   greatest(d.at, o.at) AS born, greatest(d.ts, o.ts) AS born_ts, CAST(NULL AS VARCHAR) AS gone
            FROM v_ev_detail d JOIN v_ev_order o USING (order_id) WHERE o.ts BETWEEN d.ts - {life} AND d.ts + {life}),
        {left_join("acted", "placed", "v_ev_activity", "activity_id, activity_rule_id")},
        {left_join("whole", "acted", "v_ev_coupon", "coupon_id")},
        emitted AS (SELECT *, born AS e, 1 AS sign FROM whole UNION ALL SELECT *, gone, -1 FROM whole WHERE gone IS NOT NULL)
        SELECT id, order_id, user_id, sku_id, province_id, coalesce(activity_id, '') AS activity_id,
               coalesce(activity_rule_id, '') AS activity_rule_id, coalesce(coupon_id, '') AS coupon_id, sku_num,
               {_money("split_total_amount")}, sign, CAST(e[15] AS BIGINT) AS side,
               strftime(strptime(e[1:14], '%Y%m%d%H%M%S'), {STAMP}) AS at_ts
        FROM emitted"""


def _quiet(seconds: int) -> str:
    order = "ts, sku_id, sku_num, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount"
    return f"""
        SELECT id, sku_id, sku_num, {_money("split_total_amount")}, {_stamp("ts")}, strftime(ts + INTERVAL '{seconds} seconds', {STAMP}) AS emit_ts
        FROM (SELECT *, lead(ts) OVER (PARTITION BY id ORDER BY {order}) AS next_ts FROM v_detail)
        WHERE next_ts IS NULL OR next_ts > ts + INTERVAL '{seconds} seconds'"""


SQL: dict[str, str] = {
    "wide_changelog": _emissions(3_650),
    "wide_changelog_expiring": _emissions(60),
    "detail_price_as_of": f"""
        SELECT d.id, d.order_id, d.sku_id, d.sku_num, {_stamp("d.asked_ts")},
               coalesce(CASE WHEN v.op = 'u' THEN CAST(v.price AS DOUBLE) END, 0) AS price,
               coalesce(CASE WHEN v.op = 'u' THEN v.supplier END, '') AS supplier
        FROM (SELECT *, ts - to_hours(CAST(sku_num AS INTEGER)) AS asked_ts FROM v_detail) d
        ASOF LEFT JOIN v_sku_version v ON d.sku_id = v.sku_id AND d.asked_ts >= v.ts""",
    "snapshot_handover": """
        SELECT 'r' AS op, id, high AS seq, order_status, total_amount FROM (
            SELECT * FROM v_log3 WHERE seq <= high QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
        WHERE op <> 'd'
        UNION ALL
        SELECT op, id, seq, order_status, total_amount FROM v_log3 WHERE seq > high""",
    "detail_emissions": _quiet(5),
    "detail_emissions_year": _quiet(365 * 86_400),
    "province_order_emissions": f"""
        WITH {_SIGNED.format(versions="SELECT DISTINCT d.*, o.province_id FROM v_detail d JOIN v_order o ON d.order_id = o.id")}, ordered AS (
            SELECT *, time_bucket(INTERVAL '10 seconds', ts) AS w,
                   sum(sign) OVER (PARTITION BY time_bucket(INTERVAL '10 seconds', ts), province_id, order_id
                                   ORDER BY place, id, n, sign ROWS UNBOUNDED PRECEDING) AS held
            FROM signed
        )
        SELECT {_window("10 seconds", "ts")}, province_id, order_id, id, sign, {_stamp("at_ts")},
               CAST(sum(CASE WHEN held > 0 AND held - sign <= 0 THEN 1 WHEN held <= 0 AND held - sign > 0 THEN -1 ELSE 0 END) OVER p AS BIGINT) AS order_count,
               CAST(sum(sign * split_total_amount) OVER p AS DOUBLE) AS order_amount
        FROM ordered WINDOW p AS (PARTITION BY w, province_id ORDER BY place, id, n, sign ROWS UNBOUNDED PRECEDING)""",
    "sku_order_emissions": f"""
        WITH {_SIGNED.format(versions="SELECT DISTINCT * FROM v_detail")}
        SELECT {_window("5 seconds", "ts")}, sku_id, id, sign, {_stamp("at_ts")}, {", ".join(
            f"CAST(sum(sign * {c}) OVER p AS DOUBLE) AS {name}" for c, name in (
                ("split_original_amount", "original_amount"), ("split_activity_amount", "activity_reduce_amount"),
                ("split_coupon_amount", "coupon_reduce_amount"), ("split_total_amount", "order_amount")))}
        FROM signed
        WINDOW p AS (PARTITION BY time_bucket(INTERVAL '5 seconds', ts), sku_id ORDER BY place, id, n, sign ROWS UNBOUNDED PRECEDING)""",
    "user_device_running": f"""
        SELECT uid, {_stamp("ts")}, seq, row_number() OVER u AS pv, {", ".join(
            f"CAST(sum(CASE WHEN {c} <> '' AND nth_{c} = 1 THEN 1 ELSE 0 END) OVER u AS BIGINT) AS n_{c}" for c in ("os", "ch", "md", "ba", "search_item"))}
        FROM (SELECT *, {", ".join(
            f"row_number() OVER (PARTITION BY uid, {c} ORDER BY ts, seq) AS nth_{c}" for c in ("os", "ch", "md", "ba", "search_item"))} FROM v_device)
        WINDOW u AS (PARTITION BY uid ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)""",
    "log_parse_dirty": """
        SELECT seq, CASE WHEN k = 97 THEN 1 ELSE 0 END AS dirty, CASE WHEN k = 97 THEN '' ELSE uid END AS mid,
               CASE WHEN k = 97 OR event_type = 'signup' THEN '' ELSE page_id END AS page_id,
               CASE WHEN k = 97 THEN 0 ELSE ts_ms END AS ts, CASE WHEN k = 97 THEN -1 ELSE k % 3 END AS displays
        FROM v_log""",
    "log_parse_good": "SELECT seq, ts_ms AS ts, vc, ch FROM v_log WHERE k <> 97",
    "log_split_err": "SELECT seq, k AS error_code, 'error ' || (k % 10) AS msg FROM v_log WHERE event_type = 'error'",
    "log_split_start": """
        SELECT seq, uid AS mid, CASE WHEN k % 2 = 0 THEN 'icon' ELSE 'notice' END AS entry, k * 10 AS loading_time,
               k % 20 AS open_ad_id, ts_ms AS ts
        FROM v_log WHERE event_type = 'signup'""",
    "log_split_display": """
        SELECT seq, uid AS mid, page_id, k || '-' || n AS item, k % 5 AS pos_id, n AS pos_seq, ts_ms AS ts
        FROM v_pages JOIN range(1, 3) r(n) ON n <= k % 3""",
    "log_split_action": """
        SELECT seq, uid AS mid, page_id, CASE WHEN n = 1 THEN 'get_coupon' ELSE 'cart_add' END AS action_id,
               CAST(k AS VARCHAR) AS item, ts_ms + n AS action_ts
        FROM v_pages JOIN range(1, 3) r(n) ON n <= n_actions""",
    "log_split_page": """
        SELECT seq, uid AS mid, vc, page_id, last_page_id, item, during_time, ts_ms AS ts FROM v_pages""",
    "fix_is_new": _NEWCOMER,
    "device_search_base": f"SELECT seq, uid, {_stamp('ts')}, os, ch, md, ba, search_item FROM v_device",
    "uv_flag": """
        SELECT seq, uid AS mid,
               CASE WHEN row_number() OVER (PARTITION BY uid, CAST(ts AS DATE) ORDER BY ts, seq) = 1 THEN 1 ELSE 0 END AS uv_ct,
               CASE WHEN last_page_id = '' THEN 1 ELSE 0 END AS sv_ct
        FROM v_pages""",
    "traffic_page_view_window": f"""
        SELECT {_window("10 seconds", "any_value(ts)")}, vc, ch, ar, is_new,
               CAST(sum(uv) AS BIGINT) AS uv_ct, count(*) FILTER (last_page_id = '') AS sv_ct, count(*) AS pv_ct,
               CAST(sum(during_time) AS BIGINT) AS dur_sum
        FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY uid, CAST(ts AS DATE) ORDER BY ts, seq) = 1
                             THEN 1 ELSE 0 END AS uv FROM v_pages)
        GROUP BY time_bucket(INTERVAL '10 seconds', ts), vc, ch, ar, is_new""",
    "home_detail_uv_window": f"""
        SELECT {_window("5 seconds", "any_value(ts)")}, count(*) FILTER (page_id = 'home') AS home_uv_ct,
               count(*) FILTER (page_id = 'good_detail') AS good_detail_uv_ct
        FROM (SELECT *, row_number() OVER (PARTITION BY uid, page_id, CAST(ts AS DATE) ORDER BY ts, seq) AS n
              FROM v_pages WHERE page_id IN ('home', 'good_detail'))
        WHERE n = 1 GROUP BY time_bucket(INTERVAL '5 seconds', ts)""",
    "user_login_window": f"""
        SELECT {_window("1 second", "any_value(ts)")}, count(*) FILTER (pause >= 8) AS back_ct, count(*) AS uu_ct
        FROM (SELECT *, day - lag(day) OVER (PARTITION BY uid ORDER BY day) AS pause FROM (
                  SELECT uid, CAST(ts AS DATE) AS day, min(ts) AS ts FROM v_pages
                  WHERE last_page_id IN ('login', '') GROUP BY uid, CAST(ts AS DATE)))
        GROUP BY time_bucket(INTERVAL '1 second', ts)""",
    "keyword_window": f"""
        SELECT {_window("10 seconds", "any_value(ts)", "%Y%m%d")}, keyword, count(*) AS keyword_count
        FROM (SELECT ts, unnest(regexp_split_to_array(lower(item), '[^\\p{{L}}\\p{{N}}]+')) AS keyword
              FROM v_pages WHERE last_page_id = 'search' AND item_type = 'keyword')
        WHERE keyword <> '' GROUP BY time_bucket(INTERVAL '10 seconds', ts), keyword""",
    "page_log_distinct": """
        SELECT DISTINCT uid, strftime(ts, '%Y-%m-%d') AS day, os, md, search_item FROM v_device""",
    "dedup_pair": """
        SELECT user_id, k, event_type, ts_ms, seq FROM v_events
        QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts_ms, seq) = 1""",
    "dedup_pair_filtered": """
        SELECT user_id, k, event_type, ts_ms, seq, 0.01::DOUBLE AS rate_asked, 1::BIGINT AS rate_held
        FROM v_events e WHERE ts >= TIMESTAMP '2024-01-16' AND NOT EXISTS (
            SELECT 1 FROM v_events b WHERE b.user_id = e.user_id AND b.k = e.k AND b.ts < TIMESTAMP '2024-01-16')
        QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts_ms, seq) = 1""",
    "rows_to_json": """
        SELECT '{"event_seq":' || seq || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM v_events""",
    "cdc_flatten": """
        SELECT id || '_' || ts_ms AS id_ts, op, 'shop' AS database, table_name, before, after, CAST(ts_ms AS VARCHAR) AS ts
        FROM v_change""",
    "cdc_audit_latest": """
        SELECT table_name, id || '_' || ts_ms AS id_ts, op, CAST(ts_ms AS VARCHAR) AS ts, after FROM v_change
        QUALIFY row_number() OVER (PARTITION BY table_name, id, ts_ms ORDER BY CASE op WHEN 'd' THEN 3 WHEN 'u' THEN 2 WHEN 'c' THEN 1 ELSE 0 END DESC, before DESC, after DESC) = 1""",
    "cdc_row_image": """
        SELECT op, 'order_info' AS table_name, CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN op = 'd' THEN '1001' ELSE new_status END AS order_status, amount AS total_amount, ts_ms
        FROM v_order_change""",
    "route_fact": """
        SELECT 'dwd_order_info' AS sink_table, 'id=' || o_orderkey || ',total_amount=' || amount || ',user_id=' || o_custkey AS payload, ts_ms AS ts
        FROM v_order_change WHERE op <> 'd'
        UNION ALL
        SELECT 'dwd_order_detail', 'id=' || l_orderkey || '-' || l_linenumber || ',sku_id=' || l_partkey || ',sku_num=' || CAST(l_quantity AS BIGINT),
               epoch_ms(l_shipdate) FROM lineitem""",
    "route_fact_as_of": """
        WITH history AS (
            SELECT n_nationkey AS n, CASE WHEN n_nationkey % 2 = 0 THEN 'order_info' ELSE 'order_detail' END AS source_table,
                   n_nationkey % 7 = 3 AS gone, TIMESTAMP '1995-01-15' + to_days(CAST(n_nationkey * 100 AS INTEGER)) AS ts FROM nation
        ), facts AS (
            SELECT 'order_info' AS source_table, ts_ms, CAST(o_orderkey AS VARCHAR) AS id, ',user_id=' || o_custkey AS second,
                   ',order_status=' || new_status || ',total_amount=' || amount AS third
            FROM v_order_change WHERE op <> 'd'
            UNION ALL
            SELECT 'order_detail', epoch_ms(l_shipdate), l_orderkey || '-' || l_linenumber, ',sku_id=' || l_partkey,
                   ',order_id=' || l_orderkey || ',sku_num=' || CAST(l_quantity AS BIGINT) FROM lineitem
        )
        SELECT 'dwd_' || f.source_table || '_' || (n % 3) AS sink_table,
               'id=' || id || CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN second ELSE third END AS payload, ts_ms AS ts
        FROM (SELECT *, make_timestamp(ts_ms * 1000) AS at_ts FROM facts) f
        ASOF JOIN history h ON f.source_table = h.source_table AND f.at_ts >= h.ts WHERE NOT gone""",
    "config_current": """
        SELECT * FROM (
            SELECT lower(p_type) || '_' || lower(p_brand) AS source_table, 'sink_' || p_size AS sink_table,
                   CASE WHEN p_size % 7 = 0 THEN 'd' ELSE 'u' END AS op, p_partkey AS seq FROM part
            QUALIFY row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_partkey DESC) = 1) WHERE op <> 'd'""",
    "dim_latest": """
        SELECT 'dim_user_info' AS sink_table, md5(CAST(c_custkey AS VARCHAR)) AS row_key,
               'id=' || c_custkey || ',name=' || c_name AS payload, 0 AS ts_ms FROM customer
        UNION ALL
        SELECT 'dim_sku_info', md5(CAST(l_partkey AS VARCHAR)), payload, epoch_ms(l_shipdate) FROM (
            SELECT *, 'id=' || l_partkey || ',price=' || CAST(l_extendedprice AS DECIMAL(16,2)) AS payload FROM lineitem
            WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F'))
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, payload DESC) = 1""",
    "dim_apply_changes": """
        WITH last AS (
            SELECT l_partkey, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'd' ELSE 'u' END AS op,
                   CASE WHEN CAST(l_quantity AS BIGINT) % 2 = 0 THEN '' ELSE 'renamed ' || l_suppkey END AS name
            FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                                       l_quantity DESC, name DESC) = 1)
        SELECT p_partkey, CASE WHEN coalesce(name, '') = '' THEN p_name ELSE name END AS p_name, p_brand
        FROM part LEFT JOIN last ON l_partkey = p_partkey WHERE op IS DISTINCT FROM 'd'""",
    "dim_lookup": """
        SELECT p_partkey, p_name, p_brand FROM part
        WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')""",
    "upsert_latest": f"""
        SELECT user_id, CAST(amount AS DOUBLE) AS amount, {_stamp("updated_at")}, seq FROM (
            SELECT c_custkey AS user_id, CAST(c_acctbal AS DECIMAL(16,2)) AS amount, TIMESTAMP '1990-01-01' AS updated_at, -1 AS seq FROM customer
            UNION ALL SELECT o_custkey, CAST(o_totalprice AS DECIMAL(16,2)), o_orderdate, o_orderkey FROM orders)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, seq DESC) = 1""",
    "day_bucket": """
        SELECT CASE WHEN event_type = 'error' THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, count(*) AS row_count
        FROM v_events GROUP BY 1""",
    "order_detail_wide": f"SELECT * REPLACE ({_money(*_AMOUNTS)}, {_stamp('ts')}) FROM v_wide",
    "changelog_order_wide": f"""
        SELECT * REPLACE ({_money(*_AMOUNTS)}, {_stamp('ts')}) FROM (
            SELECT * REPLACE (CAST(sku_num * split_original_amount AS DECIMAL(16,2)) AS split_original_amount) FROM v_wide)""",
    "changelog_payment": f"""
        SELECT w.id AS order_detail_id, w.order_id, user_id, dic_name AS payment_type_name, {_stamp("o_orderdate", "callback_ts")},
               sku_num, CAST(split_total_amount AS DOUBLE) AS split_payment_amount
        FROM v_wide w JOIN orders ON w.order_id = CAST(o_orderkey AS VARCHAR) AND o_orderstatus = 'F'
        JOIN v_dic ON dic_code = md5(o_orderpriority)
        WHERE w.ts BETWEEN o_orderdate - INTERVAL '30 days' AND o_orderdate + INTERVAL '5 days'""",
    "changelog_refund": f"""
        SELECT r.id, r.user_id, r.order_id, r.sku_id, o.province_id, strftime(r.ts, '%Y-%m-%d') AS date_id,
               t.dic_code AS refund_type_code, t.dic_name AS refund_type_name, s.dic_code AS refund_reason_type_code,
               s.dic_name AS refund_reason_type_name, refund_reason_txt, refund_num, {_money("refund_amount")}, {_stamp("r.ts")}
        FROM v_refund r JOIN v_order o ON r.order_id = o.id AND o.status = 'O'
        JOIN v_dic t ON t.dic_code = md5(refund_type) JOIN v_dic s ON s.dic_code = md5(refund_reason_type)""",
    "changelog_comment_dic": """
        SELECT id, user_id, md5(appraise) AS appraise, dic_name AS appraise_name, msg, 'comment_info' AS table_name
        FROM v_comment JOIN v_dic ON dic_code = md5(appraise)""",
    "user_device_values": """
        SELECT uid, field, value, count(*) AS views FROM (
            UNPIVOT (SELECT seq, uid, os, ch, md, ba, search_item FROM v_device) ON os, ch, md, ba, search_item INTO NAME field VALUE value)
        WHERE value <> '' GROUP BY ALL""",
    "label_merge": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS uname, CAST(c_custkey % 5 AS VARCHAR) AS user_level,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'home' END AS gender,
               CAST(150 + c_custkey % 50 AS VARCHAR) AS height, 'cm' AS unit_height, CAST(45 + c_custkey % 40 AS VARCHAR) AS weight,
               'kg' AS unit_weight, strftime(ts, '%Y%m%d') AS ds, {_stamp("ts")}
        FROM (SELECT *, TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey * 211 % 43200 + c_custkey * 7 % 21 - 10 AS INTEGER)) AS ts
              FROM customer)""",
    "order_cancel_detail": f"""
        SELECT w.id, w.order_id, user_id, sku_id, province_id, activity_id, coupon_id,
               strftime(o_orderdate, '%Y-%m-%d') AS order_cancel_date_id, sku_num, {_money(*_AMOUNTS)}, {_stamp("o_orderdate", "operate_ts")}
        FROM v_wide w JOIN v_order_change ON order_id = CAST(o_orderkey AS VARCHAR) WHERE op = 'u' AND new_status = '1003'""",
    "cart_add_detail": f"SELECT id, user_id, sku_id, sku_num, {_stamp('ts')} FROM v_cart",
    "cart_uu_window": f"""
        SELECT {_window("5 seconds", "any_value(ts)")}, count(*) AS cart_add_uu_ct
        FROM (SELECT * FROM v_cart QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts) = 1)
        GROUP BY time_bucket(INTERVAL '5 seconds', ts)""",
    "payment_detail": f"""
        SELECT w.id AS order_detail_id, w.order_id, user_id, sku_id, province_id, activity_id, coupon_id,
               dic_code AS payment_type_code, dic_name AS payment_type_name, {_stamp("o_orderdate", "callback_ts")}, sku_num,
               {_money("split_original_amount", "split_activity_amount", "split_coupon_amount")},
               CAST(split_total_amount AS DOUBLE) AS split_payment_amount
        FROM orders JOIN v_wide w ON w.order_id = CAST(o_orderkey AS VARCHAR) JOIN v_dic ON dic_code = md5(o_orderpriority)
        WHERE o_orderstatus = 'F' AND w.ts BETWEEN o_orderdate - INTERVAL '30 days' AND o_orderdate + INTERVAL '5 days'""",
    "refund_payment_detail": f"""
        SELECT r.id, o.user_id, r.order_id, r.sku_id, o.province_id, dic_code AS payment_type_code, dic_name AS payment_type_name,
               strftime(r.ts, '%Y-%m-%d') AS date_id, q.refund_num, CAST(r.refund_amount AS DOUBLE) AS total_amount, {_stamp("r.ts")}
        FROM v_refund r
        JOIN (SELECT * FROM v_refund QUALIFY row_number() OVER (PARTITION BY order_id, sku_id ORDER BY ts DESC, id DESC, refund_num DESC) = 1) q
          ON r.order_id = q.order_id AND r.sku_id = q.sku_id
        JOIN v_order o ON r.order_id = o.id AND o.status = 'F' JOIN v_dic ON dic_code = md5(r.refund_type)""",
    "refund_order_detail": f"""
        SELECT r.id, r.user_id, r.order_id, r.sku_id, o.province_id, strftime(r.ts, '%Y-%m-%d') AS date_id,
               t.dic_code AS refund_type_code, t.dic_name AS refund_type_name, s.dic_code AS refund_reason_type_code,
               s.dic_name AS refund_reason_type_name, refund_reason_txt, refund_num, {_money("refund_amount")}, {_stamp("r.ts")}
        FROM v_refund r JOIN v_order o ON r.order_id = o.id AND o.status = 'O'
        JOIN v_dic t ON t.dic_code = md5(refund_type) JOIN v_dic s ON s.dic_code = md5(refund_reason_type)""",
    "comment_dic": """
        SELECT id, user_id, md5(appraise) AS appraise, dic_name AS appraise_name, msg FROM v_comment JOIN v_dic ON dic_code = md5(appraise)""",
    "comment_dic_left": """
        SELECT id, user_id, appraise, coalesce(dic_name, 'N/A') AS dic_name FROM v_comment LEFT JOIN v_dic ON dic_code = md5(appraise)""",
    "comment_order_interval": f"""
        SELECT c.id, c.order_id, {_stamp("c.ts")}, strftime(c.ts, '%Y%m%d') AS ds, o.user_id AS info_user_id,
               o.consignee AS info_consignee, CAST(o.total_amount AS DOUBLE) AS info_total_amount, {_stamp("o.ts", "info_ts")}
        FROM v_comment c JOIN v_order o ON c.order_id = o.id
        WHERE o.ts BETWEEN c.ts - INTERVAL '400 days' AND c.ts + INTERVAL '400 days'""",
    "order_detail_interval": f"""
        SELECT * REPLACE ({_money("total_amount", *_AMOUNTS[1:])}, {_stamp("create_ts")}, {_stamp("detail_ts")}) FROM v_order_detail""",
    "detail_latest_only": f"""
        SELECT * REPLACE ({_money("total_amount", *_AMOUNTS[1:])}, {_stamp("create_ts")}, {_stamp("detail_ts")}) FROM v_newest_detail""",
    "user_latest_only": """
        SELECT * EXCLUDE (best) FROM (
            SELECT o_custkey, o_orderkey, epoch_ms(o_orderdate) AS ts_ms,
                   max(epoch_ms(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
            FROM orders) WHERE best IS NULL OR ts_ms > best""",
    "retract_dedup": f"""
        SELECT id, sku_id, sku_num, {", ".join(f"CAST({a} * sign AS DOUBLE) AS {a}" for a in _AMOUNTS)}, sign, {_stamp("ts")}
        FROM v_signed""",
    "detail_latest_held": f"""
        SELECT id, sku_id, sku_num, CAST(split_total_amount AS DOUBLE) AS split_total_amount, {_stamp("ts")} FROM v_detail
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, sku_id DESC, sku_num DESC, split_original_amount DESC,
            split_activity_amount DESC, split_coupon_amount DESC, split_total_amount DESC) = 1""",
    "order_paid_transition": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(amount AS DOUBLE) AS total_amount,
               {_stamp("o_orderdate", "ts")}
        FROM v_order_change WHERE op = 'u' AND new_status = '1002'""",
    "order_detail_records": f"""
        SELECT id, order_id, sku_id, sku_num, {_stamp("ts")} FROM v_detail""",
    "user_records": """
        SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS uname, 'home' AS gender, '1970-01-01 00:00:00.000' AS ts FROM customer""",
    "search_records": """
        SELECT CAST(seq % 3 AS INTEGER) AS query_id, p_name AS query, CAST(k AS INTEGER) AS doc_id, 'shop ' || (seq % 3) AS title,
               ts_ms AS "timestamp", event_type AS "type"
        FROM v_events JOIN part ON k = p_partkey WHERE seq % 3 > 0 AND event_type <> 'error' AND k > 0""",
    "keyword_udtf": """
        SELECT role, word, count(*) AS word_count FROM (
            SELECT role, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM conversations)
        WHERE word <> '' GROUP BY role, word""",
    "sku_order_window": f"""
        SELECT {_window("5 seconds", "any_value(ts)")}, sku_id, CAST(sum(split_original_amount * sign) AS DOUBLE) AS original_amount,
               CAST(sum(split_activity_amount * sign) AS DOUBLE) AS activity_reduce_amount,
               CAST(sum(split_coupon_amount * sign) AS DOUBLE) AS coupon_reduce_amount,
               CAST(sum(split_total_amount * sign) AS DOUBLE) AS order_amount
        FROM v_signed GROUP BY time_bucket(INTERVAL '5 seconds', ts), sku_id""",
    "province_order_window": f"""
        SELECT {_window("10 seconds", "any_value(s.ts)")}, province_id, any_value(n_name) AS province_name,
               count(DISTINCT order_id) AS order_count, CAST(sum(split_total_amount * sign) AS DOUBLE) AS order_amount
        FROM v_signed s JOIN v_order o ON s.order_id = o.id LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = province_id
        GROUP BY time_bucket(INTERVAL '10 seconds', s.ts), province_id""",
    "sku_dim_chain": f"""
        SELECT strftime(day, {SECOND}) AS stt, sku_id, p_name AS sku_name, CAST(spu AS VARCHAR) AS spu_id, 'spu-' || spu AS spu_name,
               p_brand AS trademark_id, lower(p_brand) AS trademark_name, CAST(c3 AS VARCHAR) AS category3_id, 'c3-' || c3 AS category3_name,
               CAST(c2 AS VARCHAR) AS category2_id, 'c2-' || c2 AS category2_name, CAST(c1 AS VARCHAR) AS category1_id,
               'c1-' || c1 AS category1_name, CAST(amount AS DOUBLE) AS order_amount
        FROM (SELECT date_trunc('day', ts) AS day, sku_id, sum(split_total_amount * sign) AS amount FROM v_signed GROUP BY ALL)
        LEFT JOIN v_parts ON sku_id = CAST(p_partkey AS VARCHAR)""",
    "category_hierarchy": """
        SELECT DISTINCT CAST(c3 AS VARCHAR) AS id, 'c3-' || c3 AS b3name, 'c2-' || c2 AS b2name, 'c1-' || c1 AS b1name FROM v_parts""",
    "sku_snapshot": """
        SELECT CAST(p_partkey AS VARCHAR) AS skuid, CAST(spu AS VARCHAR) AS spuid, CAST(spu % 10 AS VARCHAR) AS c3id,
               'brand#' || (spu % 25 + 1) AS tname FROM v_parts""",
    "shop_actions_clean": """
        SELECT action_id, user_id, shop_id, stat_date, action_type, CAST(amount AS DOUBLE) AS amount, related_id FROM v_clean""",
    "shop_actions_invalid": """
        SELECT action_id, CASE event_type WHEN 'click' THEN 'interact' ELSE event_type END AS raw_type,
               CASE event_type WHEN 'click' THEN 'interaction does not count' ELSE 'unknown action type' END AS invalid_reason
        FROM v_actions WHERE event_type = 'error' OR (event_type = 'click' AND NOT (duration < 3 AND liked))""",
    "shop_actions_by_type": """
        SELECT action_type, shop_id, count(*) AS action_count FROM v_clean GROUP BY action_type, shop_id""",
    "new_visit_events": _EVENTS + _new(30),
    "new_visit_events_3d": _EVENTS + _new(3),
    "return_visit_events": _EVENTS + _RETURN,
    "old_customer_events": _EVENTS + _old(365),
    "old_customer_events_3d": _EVENTS + _old(3),
    "new_visit_metrics": _metrics(_new(30), "visit_count", "paid_count", "unpaid_count"),
    "return_visit_metrics": _metrics(_RETURN, "visit_count", "paid_count", "unpaid_count"),
    "old_customer_metrics": _metrics(_old(365), "revisit_count", "repurchase_count", "non_repurchase_count"),
    "shop_customer_day": """
        SELECT shop_id, stat_date, count(DISTINCT user_id) AS customer_count FROM v_clean GROUP BY shop_id, stat_date""",
    "shop_sales_day": f"""
        SELECT shop_id, stat_date, {_money("total_sales", "new_sales", "return_sales", "old_sales")} FROM ({_SALES})""",
    "segment_payment_ratio": f"""
        SELECT shop_id, stat_date, round(CAST(new_sales AS DOUBLE) / CAST(total_sales AS DOUBLE), 6) AS new_ratio,
               round(CAST(return_sales AS DOUBLE) / CAST(total_sales AS DOUBLE), 6) AS return_ratio,
               round(CAST(old_sales AS DOUBLE) / CAST(total_sales AS DOUBLE), 6) AS old_ratio
        FROM ({_SALES})""",
    "search_log_clean": """
        SELECT query_id, query, doc_id, title, "timestamp", "type" FROM v_search_ok""",
    "query_count_window": "SELECT * FROM v_query_count",
    "hot_query_topn": """
        SELECT query, CAST(sum(query_count) AS BIGINT) AS query_count, max(window_end) AS last_window_end,
               row_number() OVER (ORDER BY sum(query_count) DESC, query) AS rank
        FROM v_query_count GROUP BY query QUALIFY rank <= 10""",
    "hot_query_changes": """
        WITH totals AS (
            SELECT query, window_end, sum(query_count) OVER (PARTITION BY query ORDER BY window_end) AS total,
                   lead(window_end) OVER (PARTITION BY query ORDER BY window_end) AS until
            FROM v_query_count
        ), windows AS (
            SELECT w_end, row_number() OVER (ORDER BY w_end) AS n FROM (SELECT DISTINCT window_end AS w_end FROM v_query_count)
        ), listed AS (
            SELECT w_end, n, query, total, row_number() OVER (PARTITION BY w_end ORDER BY total DESC, query) AS rank
            FROM windows JOIN totals ON window_end <= w_end AND (until IS NULL OR until > w_end)
            QUALIFY rank <= 10
        ), both_lists AS (
            SELECT n, query, max(rank) AS rank, max(previous_rank) AS previous_rank, max(total) AS query_count FROM (
                SELECT n, query, rank, 0 AS previous_rank, total FROM listed
                UNION ALL
                SELECT n + 1, query, 0, rank, total FROM listed WHERE n < (SELECT max(n) FROM windows))
            GROUP BY n, query
        )
        SELECT w_end AS window_end, query, CASE WHEN previous_rank = 0 THEN 'entered' WHEN rank = 0 THEN 'left' ELSE 'moved' END AS change,
               rank, previous_rank, CAST(query_count AS BIGINT) AS query_count
        FROM both_lists JOIN windows USING (n) WHERE rank <> previous_rank""",
    "keyword_tokens": """
        SELECT lang, keyword, count(*) AS keyword_count FROM (
            SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS keyword FROM documents)
        WHERE keyword <> '' GROUP BY lang, keyword""",
    "comment_blacklist": "SELECT id, last_word, is_violation FROM v_graded",
    "comment_moderation": "SELECT id, is_violation, violation_grade, violation_msg FROM v_moderated",
    "ban_list": f"""
        SELECT id, user_id, consignee, {_stamp("ts")}, strftime(ts, '%Y%m%d') AS ds, msg, is_violation, violation_grade, violation_msg
        FROM v_moderated QUALIFY row_number() OVER (PARTITION BY order_id, ts ORDER BY id) = 1""",
    "user_device_rollup": f"""
        SELECT uid, count(*) AS pv, string_agg(DISTINCT os, ',' ORDER BY os) AS os, string_agg(DISTINCT ch, ',' ORDER BY ch) AS ch,
               string_agg(DISTINCT md, ',' ORDER BY md) AS md, string_agg(DISTINCT ba, ',' ORDER BY ba) AS ba,
               coalesce(string_agg(DISTINCT nullif(search_item, ''), ',' ORDER BY nullif(search_item, '')), '') AS search_item,
               strftime(max(ts), {STAMP}) AS ts
        FROM v_device GROUP BY uid""",
    "user_device_latest_window": f"""
        SELECT uid, strftime(w, {SECOND}) AS stt, strftime(w + INTERVAL '2 minutes', {SECOND}) AS edt, pv, os, ch, md, ba, search_item,
               {_stamp("ts")} FROM v_device_window""",
    "score_device": f"SELECT uid, {_stamp('ts')}, judge_os, {_scores('device')} FROM v_searched",
    "score_search": f"SELECT uid, {_stamp('ts')}, search_item, search_category, {_scores('search')} FROM v_searched",
    "pay_time_slot": f"""
        SELECT id, user_id, {_stamp("create_ts", "ts")}, {_slot("create_ts")} AS pay_time_slot FROM v_label_order""",
    "score_time": f"""
        SELECT id, pay_time_slot, {_scores("time")} FROM (SELECT id, {_slot("create_ts")} AS pay_time_slot FROM v_label_order)""",
    "score_amount": f"""
        SELECT id, spending_pow, {_scores("amount")} FROM (SELECT id, {_POWER} AS spending_pow FROM v_label_order)""",
    "score_named_groups": f"""
        SELECT id, tname, b1_name, {_real("brand")}, {_real("category")} FROM (
            SELECT id, {_BRANDS}[CAST(sku_id AS BIGINT) % {len(_BRANDS)} + 1] AS tname,
                   {_CATEGORIES}[CAST(sku_id AS BIGINT) % {len(_CATEGORIES)} + 1] AS b1_name FROM v_detail)""",
    "score_brand": f"""
        SELECT d.id, d.sku_id, sku_num, {_stamp("ts")}, tname, {_scores("brand")} FROM v_detail d JOIN v_sku_dims s ON d.sku_id = s.sku_id""",
    "score_category": f"""
        SELECT d.id, d.sku_id, sku_num, {_stamp("ts")}, b1_name, {_scores("category")} FROM v_detail d JOIN v_sku_dims s ON d.sku_id = s.sku_id""",
    "user_profile": f"""
        SELECT uid, uname, user_level, login_name, phone_num, email, gender, strftime(birthday, '%Y-%m-%d') AS birthday, decade, age,
               zodiac_sign, {_stamp("ts")} FROM v_profile""",
    "user_profile_interval": f"""
        SELECT uid, uname, gender, age, zodiac_sign, height, weight, {_stamp("ts")}, {_stamp("sup_ts")} FROM v_profile_sup""",
    "label_scores_join": f"""
        SELECT uid, {_stamp("ts")}, detail_id, {_stamp("order_ts")}, {_money(*[f"sum_{b}" for b in labels.BUCKETS])} FROM v_label_scores""",
    "label_max_bucket": f"""
        SELECT uid, {_stamp("ts")}, detail_id, {_stamp("order_ts")}, best_bucket, {_money("best_score")} FROM v_best""",
    "user_label": f"""
        SELECT b.uid, uname, {_stamp("b.ts")}, strftime(b.ts, '%Y%m%d') AS ds, decade, zodiac_sign, height, judge_os, age AS base_age,
               pv AS intraday_pv, search_item, pay_time_slot AS login_time_slot, CAST(sum_18_24 AS DOUBLE) AS age_sum18_24, spending_pow,
               best_bucket, sku_id, b1_name
        FROM v_best b JOIN v_profile_sup p ON b.uid = p.uid
        WHERE p.ts BETWEEN b.ts - INTERVAL '6 hours' AND b.ts + INTERVAL '6 hours'""",
    "text_charset_quality": f"""
        SELECT *, round(CAST(clean_texts AS DOUBLE) / text_count, 6) AS text_share,
               CASE WHEN token_count > 0 THEN round(CAST(clean_tokens AS DOUBLE) / token_count, 6) ELSE 0.0::DOUBLE END AS token_share
        FROM (SELECT source, lang, count(*) AS text_count, count(*) FILTER (regexp_full_match(text, '{CLEAN_CHARACTERS}')) AS clean_texts,
                     CAST(sum(len(tokens)) AS BIGINT) AS token_count,
                     CAST(sum(len([t FOR t IN tokens IF regexp_full_match(t, '{CLEAN_CHARACTERS}')])) AS BIGINT) AS clean_tokens
              FROM (SELECT *, [t FOR t IN regexp_split_to_array(text, '\\s+') IF t <> ''] AS tokens FROM documents)
              GROUP BY source, lang)""",
    "hash_bucket_skew": """
        SELECT bucket, row_count, round(row_count / avg(CAST(row_count AS DOUBLE)) OVER (), 4) AS skew FROM (
            SELECT lpad(CAST(CAST('0x' || right(md5(CAST(l_orderkey AS VARCHAR)), 3) AS INTEGER) % 128 AS VARCHAR), 4, '0') AS bucket,
                   count(*) AS row_count FROM lineitem GROUP BY 1)""",
    "row_key_table": """
        SELECT md5(l_orderkey || '_' || l_linenumber) AS row_key, count(*) AS row_count FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "daily_metric_filled": """
        WITH metric AS (
            SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(16,2))) AS v FROM v_events GROUP BY ALL)
        SELECT s.user_id, strftime(s.day, '%Y%m%d') AS day, coalesce(n, 0) AS event_count, CAST(coalesce(v, 0) AS DOUBLE) AS value_sum
        FROM (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL '1 day')) AS DATE) AS day FROM metric GROUP BY user_id) s
        LEFT JOIN metric m ON m.user_id = s.user_id AND m.day = s.day""",
}

_VIEW_NAME = re.compile(r"\bv_[a-z_0-9]+\b")


def _needed(sql: str, seen: list[str]) -> list[str]:
    """Views a statement uses, each after the ones it is built on."""
    for name in _VIEW_NAME.findall(sql):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def statement(name: str) -> str:
    """The full statement of a query, with the views it needs in front."""
    body = SQL[name]
    views = [f"{v} AS ({VIEWS[v]})" for v in _needed(body, [])]
    if body.lstrip().upper().startswith("WITH "):
        body = body.lstrip()[5:]
        sql = "WITH " + ",\n".join([*views, body]) if views else "WITH " + body
    else:
        sql = ("WITH " + ",\n".join(views) + "\n" if views else "") + body
    for mark, value in _FILL.items():
        sql = sql.replace(mark, value)
    return sql


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in SQL}
