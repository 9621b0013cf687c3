"""Search log: parsing, counts per window, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions import times
from millrace.operators.running import Running, running

FIELDS = ["query_id", "query", "doc_id", "title", "timestamp", "type"]


def parse_search_log(raw: DataFrame, column: str = "value") -> DataFrame:
    """Comma-separated lines to typed columns; a field that does not parse is null."""
    parts = F.split(F.col(column), ",")
    field = {name: F.get(parts, F.lit(i)) for i, name in enumerate(FIELDS)}
    return raw.select(
        field["query_id"].try_cast("int").alias("query_id"),
        field["query"].alias("query"),
        field["doc_id"].try_cast("int").alias("doc_id"),
        field["title"].alias("title"),
        field["timestamp"].try_cast("bigint").alias("timestamp"),
        field["type"].alias("type"),
    )


def valid_search_log(parsed: DataFrame) -> DataFrame:
    return parsed.where(
        (F.col("query_id") > 0)
        & (F.col("doc_id") > 0)
        & (F.coalesce(F.col("query"), F.lit("")) != "")
        & F.col("timestamp").isNotNull()
        & (F.coalesce(F.col("type"), F.lit("")) != "")
    )


def search_log_clean(raw: DataFrame, column: str = "value") -> DataFrame:
    """Valid search records with their time as a timestamp."""
    valid = valid_search_log(parse_search_log(raw, column))
    return valid.withColumn("ts", times.millis_to_timestamp(F.col("timestamp")))


GOODS_FIELDS = ["shop_id", "shop_name", "g_id", "g_name", "ts", "labels"]


def parse_goods_log(raw: DataFrame, column: str = "value") -> DataFrame:
    """Comma-separated goods lines to text columns; labels are the sixth field."""
    parts = F.split(F.col(column), ",")
    return raw.select(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(GOODS_FIELDS)])


def search_records(goods: DataFrame) -> DataFrame:
    """Goods records under the names of the search log, valid ones only."""
    renamed = goods.select(
        F.col("shop_id").try_cast("int").alias("query_id"),
        F.col("g_name").alias("query"),
        F.col("g_id").try_cast("int").alias("doc_id"),
        F.col("shop_name").alias("title"),
        F.col("ts").try_cast("bigint").alias("timestamp"),
        F.col("labels").alias("type"),
    )
    valid = valid_search_log(renamed)
    return valid.withColumn("ts", times.millis_to_timestamp(F.col("timestamp")))


def query_count_window(searches: DataFrame, width: str = "3 seconds") -> DataFrame:
    """Searches per query and window."""
    counted = searches.groupBy(F.window("ts", width), "query").agg(F.count(F.lit(1)).alias("query_count"))
    return counted.select(
        "query",
        "query_count",
        F.unix_millis(F.col("window.start")).alias("window_start"),
        F.unix_millis(F.col("window.end")).alias("window_end"),
    )


def hot_query_topn(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n queries with most searches so far, ranked; ties by query text.

    The ranking window sees the n rows that are left after the limit.
    """
    total = counts.groupBy("query").agg(
        F.sum("query_count").alias("query_count"), F.max("window_end").alias("last_window_end")
    )
    top = total.orderBy(F.desc("query_count"), "query").limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("query_count"), "query"))
    return top.select("query", "query_count", "last_window_end", rank.cast("bigint").alias("rank"))


def hot_query_changes(counts: DataFrame, n: int = 10, stretch: int = 3_600_000) -> DataFrame:
    """How the n queries with most searches so far change, window by window.

    ``counts`` has query, query_count and window_end (milliseconds), one row per query and window. One row per query
    that entered the list, left it or moved in it at a window: window_end, query, change, rank (0 for one that left),
    previous_rank (0 for one that entered) and its count by then, of one that left the last one listed. Ties go by the
    query's text.

    Time is cut into stretches of ``stretch`` milliseconds. Counts never fall, so what the n-th query had at the end of
    an earlier stretch bounds a later one's list from below; a count under the bound takes no part. What is left in a
    stretch is ranked at each of the stretch's windows; ranks stop at n before rows meet.
    """
    cut = F.floor(F.col("window_end") / stretch)
    summed = running(counts, ["query"], ["window_end"], cut, [Running("total", "sum", F.col("query_count"), through=True)])
    rows = summed.select("query", "window_end", "total", cut.alias("stretch"))

    # The n-th largest total of those counted in a stretch, in two steps; null where fewer were.
    ends = rows.groupBy("stretch", "query").agg(F.max("total").alias("total"))
    by_size = Window.partitionBy("stretch").orderBy(F.desc("total"), "query")
    nth = ends.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= n)
    nth = nth.groupBy("stretch").agg(F.max("rank").alias("rank"), F.min("total").alias("total"))
    least = nth.select("stretch", F.when(F.col("rank") == n, F.col("total")).alias("least"))
    earlier = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # One row per stretch of time.
    bounds = least.select("stretch", F.coalesce(F.max("least").over(earlier), F.lit(0)).alias("bound"))

    # A total holds until the query's next window. It takes part in stretches up to the last one whose bound it meets.
    held = running(rows, ["query"], ["window_end"], F.col("stretch"), [Running("until", "last", F.col("window_end"))], backward=True)
    totals = rows.select("total").distinct()
    known = bounds.groupBy(F.col("bound").alias("total")).agg(F.max("stretch").alias("to"))
    placed = totals.select("total", F.lit(None).cast("bigint").alias("to")).unionByName(known).withColumn("all", F.lit(0))
    placed = placed.withColumn("kind", F.col("to").isNull().cast("int"))
    reach = running(placed, ["all"], ["total", "kind"], F.floor(F.col("total") / 1_024), [Running("last", "max", F.col("to"))])
    reach = reach.where("kind = 1").select("total", "last")
    spans = held.join(reach, "total").withColumn("to", F.least(F.coalesce(F.floor((F.col("until") - 1) / stretch), F.col("last")), "last"))
    spread = spans.where(F.col("to") >= F.col("stretch")).select(
        "query", "total", "window_end", "until", F.col("stretch").alias("own"), F.explode(F.sequence("stretch", "to")).alias("stretch")
    )

    # Within a stretch: at which windows anything happens, and what holds there.
    windows = spread.where("own = stretch").groupBy("stretch").agg(F.array_sort(F.collect_set("window_end")).alias("windows"))
    seen = spread.join(windows, "stretch").select(
        "query", "total",
        F.explode(F.filter("windows", lambda w: (w >= F.col("window_end")) & (F.col("until").isNull() | (w < F.col("until"))))).alias("at"),
    )
    top = seen.withColumn("rank", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("total"), "query"))).where(F.col("rank") <= n)

    # The window before each one, over all stretches: one row per window.
    steps = windows.select("stretch", F.explode("windows").alias("at"))
    order = running(steps.withColumn("all", F.lit(0)), ["all"], ["at"], F.col("stretch"), [Running("before", "last", F.col("at"))])
    follow = running(order, ["all"], ["at"], F.col("stretch"), [Running("after", "last", F.col("at"))], backward=True)
    now = top.select("query", "at", "rank", "total", F.lit(0).alias("previous"))
    # What was listed stands against the list of the next window.
    then = top.join(follow.select("at", "after"), "at").where(F.col("after").isNotNull()).select(
        "query", F.col("after").alias("at"), F.lit(0).alias("rank"), "total", F.col("rank").alias("previous")
    )
    both = now.unionByName(then).groupBy("at", "query").agg(
        F.max("rank").cast("bigint").alias("rank"), F.max("previous").cast("bigint").alias("previous_rank"), F.max("total").alias("query_count")
    )
    change = F.when(F.col("previous_rank") == 0, "entered").when(F.col("rank") == 0, "left").otherwise("moved")
    return both.where(F.col("rank") != F.col("previous_rank")).select(
        F.col("at").alias("window_end"), "query", change.alias("change"), "rank", "previous_rank", "query_count"
    )
