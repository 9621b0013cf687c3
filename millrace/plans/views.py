"""The operators' input records, as views over the given tables.

Each view is a projection (at most with small lookups) of whole tables; nothing is filtered out to
save work. :mod:`millrace.plans.oracle` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import texts
from millrace.operators.joins import spread_lookup
from millrace.operators.labels import SEARCH
from millrace.session import configure

MINUTES_IN_30_DAYS = 43_200
PROFILE_DAY = "2024-02-01"


def money(value: Column) -> Column:
    return value.cast("decimal(16,2)")


def text(value: Column) -> Column:
    return value.cast("string")


class Inputs:
    """Views over the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- page log ------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        e = self.table("events")
        k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
        ts = F.col("ts").cast("timestamp")
        return e.select(
            F.col("event_id").alias("seq"),
            F.unix_millis(ts).alias("ts_ms"),
            "user_id",
            "event_type",
            "value",
            k.alias("k"),
        )

    def page_log(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        part = self.table("part").select(F.col("p_partkey").alias("k"), "p_name")
        rows = (
            self.events()
            .withColumn("k", F.col("k").cast("bigint"))
            .join(customer, F.col("user_id") == F.col("c_custkey"))
            .join(part, "k")
        )
        k, kind, user = F.col("k"), F.col("event_type"), text(F.col("user_id"))
        numbered = lambda prefix, n: F.concat(F.lit(prefix), text(n))
        page_id = F.element_at(
            F.array(*[F.lit(p) for p in ("home", "good_detail", "good_list", "cart", "order")]),
            (k % 5 + 1).cast("int"),
        )
        last_page = F.when(k % 4 == 1, "login").when(k % 4 == 2, "search").when(k % 4 == 3, "home")
        common = F.struct(
            text(F.col("c_nationkey")).alias("ar"),
            numbered("ba", k % 4).alias("ba"),
            F.col("c_mktsegment").alias("ch"),
            F.when(k % 4 == 0, "1").otherwise("0").alias("is_new"),
            numbered("md", k % 7).alias("md"),
            user.alias("mid"),
            F.when(F.col("user_id") % 2 == 0, "iOS 13").otherwise("Android 12").alias("os"),
            F.concat_ws("-", user, text(k)).alias("sid"),
            user.alias("uid"),
            numbered("v", k % 3).alias("vc"),
        )
        page = F.struct(
            F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
            F.when(k % 2 == 0, F.col("p_name")).otherwise(text(k)).alias("item"),
            F.when(k % 2 == 0, "keyword").otherwise("sku_id").alias("item_type"),
            last_page.alias("last_page_id"),
            page_id.alias("page_id"),
        )
        start = F.struct(
            F.when(k % 2 == 0, "icon").otherwise("notice").alias("entry"),
            (k * 10).alias("loading_time"),
            (k % 20).alias("open_ad_id"),
            (k * 3).alias("open_ad_ms"),
            F.lit(0).cast("bigint").alias("open_ad_skip_ms"),
        )
        display = lambda i: F.struct(
            F.concat_ws("-", text(k), text(i)).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (k % 5).alias("pos_id"),
            i.alias("pos_seq"),
        )
        action = lambda i: F.struct(
            F.when(i == 1, "get_coupon").otherwise("cart_add").alias("action_id"),
            text(k).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (F.col("ts_ms") + i).alias("ts"),
        )
        none = F.array().cast("array<bigint>")
        upto = lambda n: F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n.cast("bigint"))).otherwise(none)
        action_count = F.when(kind == "click", 1).when(kind == "purchase", 2).otherwise(0)
        is_start = kind == "signup"
        return rows.select(
            common.alias("common"),
            F.when(~is_start, page).alias("page"),
            F.when(is_start, start).alias("start"),
            F.transform(upto(k % 3), display).alias("displays"),
            F.transform(upto(action_count), action).alias("actions"),
            F.when(
                kind == "error", F.struct(k.alias("error_code"), numbered("error ", k % 10).alias("msg"))
            ).alias("err"),
            F.col("ts_ms").alias("ts"),
            "seq",
        )

    def raw_log(self) -> DataFrame:
        """Page log as JSON text; records with item 97 arrive without their closing brace."""
        log = self.page_log()
        line = F.to_json(F.struct(*log.columns))
        torn = F.col("common.sid").endswith("-97")
        return log.select(
            "seq", F.when(torn, F.regexp_replace(line, "\\}$", "")).otherwise(line).alias("value")
        )

    # --- shop actions and search log -----------------------------------------------------------

    def shop_actions(self) -> DataFrame:
        k, kind = F.col("k"), F.col("event_type")
        return self.events().select(
            text(F.col("seq")).alias("action_id"),
            text(F.col("user_id")).alias("user_id"),
            text(F.col("seq") % 3).alias("shop_id"),
            "ts_ms",
            F.when(kind == "view", "visit")
            .when(kind == "click", "interact")
            .when(kind == "purchase", "purchase")
            .when(kind == "signup", "follow")
            .otherwise(kind)
            .alias("action_type"),
            F.when(kind == "click", k % 5).alias("duration"),
            F.when(kind == "click", k % 2 == 0).alias("liked"),
            F.when(kind == "click", F.concat(F.lit("c"), text(k))).alias("content_id"),
            F.when(kind == "purchase", money(F.col("value")) * 10).cast("decimal(16,2)").alias("amount"),
            F.when(kind == "purchase", text(F.col("seq"))).alias("order_id"),
            "seq",
        )

    def search_lines(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").cast("int").alias("k"), "p_name")
        doc = F.when(F.col("event_type") == "error", "x").otherwise(text(F.col("k")))
        return (
            self.events()
            .join(part, "k")
            .select(
                F.concat_ws(
                    ",",
                    text(F.col("seq") + 1),
                    "p_name",
                    doc,
                    F.concat(F.lit("title "), text(F.col("k"))),
                    text(F.col("ts_ms")),
                    "event_type",
                ).alias("value")
            )
        )

    def goods_lines(self) -> DataFrame:
        """Lines shop id, shop name, goods id, goods name, time, labels; errors have no goods id."""
        part = self.table("part").select(F.col("p_partkey").cast("int").alias("k"), "p_name")
        goods = F.when(F.col("event_type") == "error", "").otherwise(text(F.col("k")))
        shop = F.col("seq") % 3
        return (
            self.events()
            .join(part, "k")
            .select(
                F.concat_ws(
                    ",",
                    text(shop),
                    F.concat(F.lit("shop "), text(shop)),
                    goods,
                    "p_name",
                    text(F.col("ts_ms")),
                    "event_type",
                ).alias("value")
            )
        )

    # --- orders --------------------------------------------------------------------------------

    def order_detail(self) -> DataFrame:
        price = money(F.col("l_extendedprice"))
        share = lambda c: money(price * F.col(c).cast("decimal(4,2)"))
        line = self.table("lineitem").select(
            F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber"))).alias("id"),
            text(F.col("l_orderkey")).alias("order_id"),
            text(F.col("l_partkey")).alias("sku_id"),
            F.concat(F.lit("sku-"), text(F.col("l_partkey"))).alias("sku_name"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            price.alias("split_original_amount"),
            share("l_discount").alias("split_activity_amount"),
            share("l_tax").alias("split_coupon_amount"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
        )
        total = F.col("split_original_amount") - F.col("split_activity_amount") - F.col("split_coupon_amount")
        return line.withColumn("split_total_amount", money(total))

    DETAIL_ORDER = [
        "ts",
        "sku_id",
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        "split_total_amount",
    ]

    def order_info(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        return (
            self.table("orders")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                text(F.col("o_orderkey")).alias("id"),
                text(F.col("o_custkey")).alias("user_id"),
                text(F.col("c_nationkey")).alias("province_id"),
                F.col("c_name").alias("consignee"),
                money(money(F.col("o_totalprice")) / 100).alias("total_amount"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_orderdate").cast("timestamp").alias("ts"),
            )
        )

    def detail_of_orders(self) -> DataFrame:
        """Details with the user and province of their order."""
        return spread_lookup(
            self.order_detail(),
            self.order_info(),
            {"order_id": "id"},
            {"user_id": "user_id", "province_id": "province_id"},
            "inner",
        )

    def activities(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_discount") > 0)
            .select(
                F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber"))).alias("order_detail_id"),
                F.concat(F.lit("act-"), text(F.col("l_suppkey") % 10)).alias("activity_id"),
                F.concat(F.lit("rule-"), text(F.round(F.col("l_discount") * 100).cast("int"))).alias("activity_rule_id"),
                F.col("l_shipdate").cast("timestamp").alias("ts"),
            )
        )

    def coupons(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_tax") > 0)
            .select(
                F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber"))).alias("order_detail_id"),
                F.concat(F.lit("cou-"), text(F.round(F.col("l_tax") * 100).cast("int"))).alias("coupon_id"),
                F.col("l_shipdate").cast("timestamp").alias("ts"),
            )
        )

    def payments(self) -> DataFrame:
        return (
            self.table("orders")
            .where(F.col("o_orderstatus") == "F")
            .select(
                text(F.col("o_orderkey")).alias("order_id"),
                F.col("o_orderpriority").alias("payment_type"),
                F.col("o_orderdate").cast("timestamp").alias("ts"),
            )
        )

    def refund_infos(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_returnflag") == "R")
            .select(
                F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber"))).alias("id"),
                text(F.col("l_orderkey")).alias("order_id"),
                text(F.col("l_partkey")).alias("sku_id"),
                text(F.col("l_suppkey")).alias("user_id"),
                F.col("l_returnflag").alias("refund_type"),
                F.col("l_linestatus").alias("refund_reason_type"),
                F.concat(F.lit("reason "), text(F.col("l_linenumber"))).alias("refund_reason_txt"),
                F.col("l_quantity").cast("bigint").alias("refund_num"),
                money(F.col("l_extendedprice")).alias("refund_amount"),
                F.col("l_shipdate").cast("timestamp").alias("ts"),
            )
        )

    def refund_payments(self) -> DataFrame:
        return self.refund_infos().select(
            "id",
            "order_id",
            "sku_id",
            F.col("refund_type").alias("payment_type"),
            F.col("refund_amount").alias("total_amount"),
            "ts",
        )

    def dictionary(self) -> DataFrame:
        """Names of the codes in use: one narrow pass over each table, joined by its size at run time."""
        pairs = self.table("lineitem").groupBy("l_returnflag", "l_linestatus").count()
        codes = (
            self.table("orders").groupBy(F.col("o_orderpriority").alias("code")).count().select("code")
            .union(pairs.select(F.explode(F.array("l_returnflag", "l_linestatus"))))
            .distinct()
        )
        return codes.select(
            F.md5("code").alias("dic_code"), F.struct(F.lower("code").alias("dic_name")).alias("info")
        )

    def provinces(self) -> DataFrame:
        return self.table("nation").select(
            text(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name")
        )

    # --- product dimensions --------------------------------------------------------------------

    def _parts(self) -> DataFrame:
        band = F.floor((F.col("p_size") - 1) / 5).cast("bigint")
        return self.table("part").select(
            "p_partkey",
            "p_name",
            "p_brand",
            (F.col("p_partkey") % 200).alias("spu"),
            band.alias("c3"),
            F.floor(band / 2).cast("bigint").alias("c2"),
            F.floor(F.floor(band / 2) / 2).cast("bigint").alias("c1"),
        )

    def sku(self) -> DataFrame:
        return self._parts().select(
            text(F.col("p_partkey")).alias("id"),
            F.col("p_name").alias("sku_name"),
            text(F.col("spu")).alias("spu_id"),
            F.col("p_brand").alias("tm_id"),
            text(F.col("c3")).alias("category3_id"),
        )

    def spu(self) -> DataFrame:
        ids = self._parts().select("spu").distinct()
        return ids.select(
            text(F.col("spu")).alias("id"),
            F.concat(F.lit("spu-"), text(F.col("spu"))).alias("spu_name"),
            text(F.col("spu") % 10).alias("category3_id"),
            F.concat(F.lit("Brand#"), text(F.col("spu") % 25 + 1)).alias("tm_id"),
        )

    def trademark(self) -> DataFrame:
        return self._parts().select(F.col("p_brand").alias("id"), F.lower("p_brand").alias("tm_name")).distinct()

    def category3(self) -> DataFrame:
        return self._named("c3", ("c2", "category2_id"))

    def category2(self) -> DataFrame:
        return self._named("c2", ("c1", "category1_id"))

    def category1(self) -> DataFrame:
        return self._named("c1")

    def _named(self, level: str, parent: tuple[str, str] | None = None) -> DataFrame:
        ids = [F.col(level)] + ([F.col(parent[0])] if parent else [])
        out = [
            text(F.col(level)).alias("id"),
            F.concat(F.lit(f"{level}-"), text(F.col(level))).alias("name"),
        ]
        if parent:
            out.append(text(F.col(parent[0])).alias(parent[1]))
        return self._parts().select(*ids).distinct().select(*out)

    def search_categories(self) -> DataFrame:
        """Searched phrase to top category: the lowest size band sold under that name."""
        band = self._parts().groupBy("p_name").agg(F.min("c3").alias("band"))
        return band.select(
            F.col("p_name").alias("b3name"), F.concat(F.lit("b1-"), text(F.col("band"))).alias("b1name")
        )

    def search_compare(self) -> DataFrame:
        """Top category to search category, in the order of the score table; the seventh has none."""
        names = F.array(*[F.lit(n) for n in SEARCH])
        bands = self._parts().select(F.col("c3").alias("band")).distinct()
        return bands.select(
            F.concat(F.lit("b1-"), text(F.col("band"))).alias("category_name"),
            F.get(names, (F.col("band") % 7).cast("int")).alias("search_category"),
        )

    # --- changelog -----------------------------------------------------------------------------

    def order_changes(self) -> DataFrame:
        status, key = F.col("o_orderstatus"), F.col("o_orderkey")
        op = (
            F.when(key % 50 == 0, "d")
            .when((status == "F") | ((status == "O") & (key % 2 == 1)), "u")
            .otherwise("r")
        )
        new_status = (
            F.when(status == "F", "1002").when((status == "O") & (key % 2 == 1), "1003").otherwise("1001")
        )
        ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
        image = lambda s: F.create_map(
            F.lit("id"), text(key),
            F.lit("operate_time"), text(ms),
            F.lit("order_status"), s,
            F.lit("total_amount"), text(money(F.col("o_totalprice"))),
            F.lit("user_id"), text(F.col("o_custkey")),
        )
        return self.table("orders").select(
            op.alias("op"),
            F.when(op.isin("u", "d"), image(F.lit("1001"))).alias("before"),
            F.when(op != "d", image(new_status)).alias("after"),
            self._source("order_info"),
            ms.alias("ts_ms"),
        )

    def detail_changes(self) -> DataFrame:
        ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
        line_id = F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber")))
        return self.table("lineitem").select(
            F.lit("r").alias("op"),
            F.lit(None).cast("map<string,string>").alias("before"),
            F.create_map(
                F.lit("id"), line_id,
                F.lit("order_id"), text(F.col("l_orderkey")),
                F.lit("sku_id"), text(F.col("l_partkey")),
                F.lit("sku_num"), text(F.col("l_quantity").cast("bigint")),
            ).alias("after"),
            self._source("order_detail"),
            ms.alias("ts_ms"),
        )

    def customer_changes(self) -> DataFrame:
        return self.table("customer").select(
            F.lit("r").alias("op"),
            F.lit(None).cast("map<string,string>").alias("before"),
            F.create_map(F.lit("id"), text(F.col("c_custkey")), F.lit("name"), F.col("c_name")).alias("after"),
            self._source("user_info"),
            F.lit(0).cast("bigint").alias("ts_ms"),
        )

    def changes(self) -> DataFrame:
        return self.order_changes().unionByName(self.detail_changes()).unionByName(self.customer_changes())

    def cart_changes(self) -> DataFrame:
        flag = F.col("l_returnflag")
        op = F.when(flag == "N", "r").when(flag == "A", "u").otherwise("c")
        image = lambda n: F.create_map(
            F.lit("id"), F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber"))),
            F.lit("user_id"), text(F.col("l_suppkey")),
            F.lit("sku_id"), text(F.col("l_partkey")),
            F.lit("sku_num"), text(n),
        )
        return self.table("lineitem").select(
            op.alias("op"),
            F.when(op == "u", image(F.col("l_linenumber") * 5)).alias("before"),
            image(F.col("l_quantity").cast("bigint")).alias("after"),
            self._source("cart_info"),
            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"),
        )

    def sku_changes(self) -> DataFrame:
        """Price and supplier of a sku as each order line reports them."""
        return self.table("lineitem").select(
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "d").otherwise("u").alias("op"),
            F.lit(None).cast("map<string,string>").alias("before"),
            F.create_map(
                F.lit("id"), text(F.col("l_partkey")),
                F.lit("price"), text(money(F.col("l_extendedprice"))),
                F.lit("supplier"), text(F.col("l_suppkey")),
            ).alias("after"),
            self._source("sku_info"),
            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"),
        )

    def sku_versions(self) -> DataFrame:
        """The history of price and supplier that :meth:`sku_changes` gives; a deletion has no values."""
        after = F.col("after")
        return self.sku_changes().select(
            after["id"].alias("sku_id"), "op", money(after["price"]).alias("price"), after["supplier"].alias("supplier"),
            F.timestamp_millis("ts_ms").alias("ts"),
        )

    # --- a table that is read while it changes -------------------------------------------------

    # Orders of a chunk, the log's length, and the positions that pass while a chunk is read.
    CHUNK, LOG_PLACES, CHUNK_PLACES = 1_000, 100_000, 8_000

    def order_log(self) -> DataFrame:
        """Three changes of each order, far apart in the log; the last one of every 50th is a deletion."""
        key = F.col("o_orderkey")
        n = F.explode(F.array(*map(F.lit, range(3))))
        rows = self.table("orders").select(key, "o_totalprice", n.alias("n"))
        gone = (F.col("n") == 2) & (key % 50 == 0)
        return rows.select(
            F.floor(key / self.CHUNK).alias("chunk"), text(key).alias("id"), self._log_place(F.col("n")).alias("seq"),
            F.when(gone, "d").when(F.col("n") == 0, "c").otherwise("u").alias("op"),
            F.when(~gone, self._order_image(F.col("n"))).alias("after"),
        )

    def order_marks(self) -> DataFrame:
        """Where the log stood before and after each chunk was read."""
        chunks = self.table("orders").select(F.floor(F.col("o_orderkey") / self.CHUNK).alias("chunk")).distinct()
        low = self._low_mark(F.col("chunk"))
        return chunks.select("chunk", low.alias("low"), (low + self.CHUNK_PLACES).alias("high"))

    def order_snapshot(self) -> DataFrame:
        """The orders as they were at some moment between their chunk's marks, another one for each."""
        key = F.col("o_orderkey")
        read = self._low_mark(F.floor(key / self.CHUNK)) + key % (self.CHUNK_PLACES + 1)
        seen = F.size(F.filter(F.array(*[self._log_place(F.lit(n)) for n in range(3)]), lambda p: p <= F.col("read")))
        rows = self.table("orders").withColumn("read", read).withColumn("n", seen - 1)
        there = (F.col("n") >= 0) & ~((F.col("n") == 2) & (key % 50 == 0))
        return rows.where(there).select(
            F.floor(key / self.CHUNK).alias("chunk"), text(key).alias("id"), self._order_image(F.col("n")).alias("row")
        )

    def _log_place(self, n: Column) -> Column:
        return F.col("o_orderkey") * 7_919 % self.LOG_PLACES + n.cast("bigint") * (self.LOG_PLACES // 2)

    def _low_mark(self, chunk: Column) -> Column:
        return F.lit(60_000) + chunk * 997 % 50_000

    @staticmethod
    def _order_image(n: Column) -> Column:
        status = F.get(F.array(*map(F.lit, ("1001", "1002", "1004"))), n.cast("int"))
        return F.create_map(F.lit("order_status"), status, F.lit("total_amount"), text(money(F.col("o_totalprice"))))

    @staticmethod
    def _source(table: str) -> Column:
        return F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.lit(table)).alias("source")

    def fact_config(self) -> DataFrame:
        return self.spark.sql(
            """
            SELECT * FROM VALUES
              ('order_info', 'dwd_order_info', 'id,user_id,total_amount'),
              ('order_detail', 'dwd_order_detail', 'id,sku_id,sku_num')
            AS config(source_table, sink_table, sink_columns)
            """
        )

    def dim_config(self) -> DataFrame:
        return self.spark.sql(
            """
            SELECT * FROM VALUES
              ('sku_info', 'dim_sku_info', 'id,price', 'id'),
              ('user_info', 'dim_user_info', 'id,name', 'id')
            AS config(source_table, sink_table, sink_columns, sink_row_key)
            """
        )

    def config_history(self) -> DataFrame:
        """Entries for two tables, one per nation and every 100 days: other sinks and columns, some deletions."""
        n = F.col("n_nationkey")
        info, detail = ("id", "id,user_id", "id,order_status,total_amount"), ("id", "id,sku_id", "id,order_id,sku_num")
        pick = lambda names: F.get(F.array(*map(F.lit, names)), (n % 3).cast("int"))
        table = F.when(n % 2 == 0, "order_info").otherwise("order_detail")
        return self.table("nation").select(
            table.alias("source_table"), F.concat_ws("_", F.lit("dwd"), table, text(n % 3)).alias("sink_table"),
            F.when(n % 2 == 0, pick(info)).otherwise(pick(detail)).alias("sink_columns"),
            F.when(n % 7 == 3, "d").otherwise("u").alias("op"),
            (F.lit("1995-01-15").cast("timestamp") + F.make_dt_interval(days=(n * 100).cast("int"))).alias("ts"),
        )

    def config_changes(self) -> DataFrame:
        """A long history of configuration entries, one per part."""
        return self.table("part").select(
            F.concat_ws("_", F.lower("p_type"), F.lower("p_brand")).alias("source_table"),
            F.concat(F.lit("sink_"), text(F.col("p_size"))).alias("sink_table"),
            F.when(F.col("p_size") % 7 == 0, "d").otherwise("u").alias("op"),
            F.col("p_partkey").alias("seq"),
        )

    # --- the facts' tables as a changelog --------------------------------------------------------

    @staticmethod
    def as_changes(rows: DataFrame, name: str, op: str = "c", ts: str = "ts", renamed: dict[str, str] | None = None) -> DataFrame:
        """Rows of a table as changes: every column is a text of the new image."""
        renamed = renamed or {}
        entries = [
            c for column in rows.columns if column != ts for c in (F.lit(renamed.get(column, column)), text(F.col(column)))
        ]
        image = F.create_map(*entries)
        return rows.select(
            F.lit(op).alias("op"),
            (image if op == "u" else F.lit(None).cast("map<string,string>")).alias("before"),
            image.alias("after"),
            F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.lit(name), F.lit("server_id"), F.lit("1")).alias("source"),
            F.unix_millis(F.col(ts).cast("timestamp")).alias("ts_ms"),
        )

    def fact_changes(self) -> DataFrame:
        """Orders in two versions, details, activities and coupons, as one changelog.

        The second version of an order comes a day later with another status, as every status change sends one.
        """
        orders = self.order_info().select("id", "user_id", "province_id", "consignee", F.col("status").alias("order_status"), "total_amount", "ts")
        later = orders.withColumn("order_status", F.lit("1004")).withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(1)))
        details = self.order_detail().select(
            "id", "order_id", "sku_id", "sku_name", "sku_num", F.col("split_original_amount").alias("order_price"),
            "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts",
        )
        parts = [
            self.as_changes(orders, "order_info"),
            self.as_changes(later, "order_info", "u"),
            self.as_changes(details, "order_detail"),
            self.as_changes(self.activities(), "order_detail_activity"),
            self.as_changes(self.coupons(), "order_detail_coupon"),
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def payment_changes(self) -> DataFrame:
        paid = self.payments().withColumn("payment_status", F.lit("1602")).withColumn(
            "callback_time", F.unix_millis(F.col("ts"))
        )
        return self.as_changes(paid, "payment_info", "u")

    def refund_changes(self) -> DataFrame:
        asked = self.refund_infos().withColumn("create_time", F.unix_millis(F.col("ts")))
        return self.as_changes(asked, "order_refund_info")

    def comment_changes(self) -> DataFrame:
        return self.as_changes(self.comments(), "comment_info", renamed={"msg": "comment_txt"})

    # --- comments ------------------------------------------------------------------------------

    def comments(self) -> DataFrame:
        """All turns of the conversations; each ends with its last word as a part of its own."""
        size = F.length("text")
        last_word = F.coalesce(F.element_at(texts.words(F.col("text")), -1), F.lit(""))
        return (
            self.table("conversations")
            .select(
                F.concat_ws("-", text(F.col("conv_id")), text(F.col("turn"))).alias("id"),
                text(F.col("conv_id")).alias("user_id"),
                text(F.col("conv_id")).alias("order_id"),
                F.concat(F.lit("c-"), text(F.col("conv_id"))).alias("consignee"),
                F.element_at(F.array(*[F.lit(c) for c in "ANRX"]), (size % 4 + 1).cast("int")).alias("appraise"),
                F.concat("text", F.lit(","), last_word).alias("msg"),
                (F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval(days=size % 1000)).alias("ts"),
            )
        )

    def words(self) -> DataFrame:
        """Different words of the benchmark table, of any length."""
        tokens = self.table("benchmark").select(F.explode(texts.words(F.col("text"))).alias("word"))
        return tokens.where(F.col("word") != "").distinct()

    # --- labels --------------------------------------------------------------------------------

    @staticmethod
    def _minutes(key: Column, factor: int, shift: Column | int = 0) -> Column:
        minutes = (key * factor % MINUTES_IN_30_DAYS + shift).cast("int")
        return F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=minutes)

    def label_orders(self) -> DataFrame:
        return self.order_info().withColumn("ts", self._minutes(F.col("id").cast("bigint"), 37))

    def label_details(self) -> DataFrame:
        line = F.split(F.col("id"), "-")[1].cast("bigint")
        return self.order_detail().withColumn(
            "ts", self._minutes(F.col("order_id").cast("bigint"), 37, line - 4)
        )

    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        day = F.date_add(F.lit("1960-01-01").cast("date"), (key * 37 % 16000).cast("int"))
        return self.table("customer").select(
            text(key).alias("uid"),
            F.col("c_name").alias("uname"),
            text(key % 5).alias("user_level"),
            F.concat(F.lit("login"), text(key)).alias("login_name"),
            F.concat(F.lit("1"), F.lpad(text(key), 10, "0")).alias("phone_num"),
            F.concat(F.lit("u"), text(key), F.lit("@mail.test")).alias("email"),
            F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").alias("gender"),
            F.unix_date(day).alias("birthday"),
            self._minutes(key, 211).alias("ts"),
        )

    def supplements(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            text(key).alias("uid"),
            text(150 + key % 50).alias("height"),
            F.lit("cm").alias("unit_height"),
            text(45 + key % 40).alias("weight"),
            F.lit("kg").alias("unit_weight"),
            self._minutes(key, 211, key * 7 % 21 - 10).alias("ts"),
        )
