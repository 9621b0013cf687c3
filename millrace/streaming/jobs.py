"""Streaming forms of joins, windows and sinks, and the multi-sink log job."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.functions import times
from millrace.operators import cdc, labels, logs, moderation, traffic
from millrace.session import checkpoint_dir
from millrace.sources.sinks import KeyedTable, run_of

# Allowed lateness of the sources.
LOG_DELAY, SQL_DELAY, NO_DELAY = "3 seconds", "5 seconds", "0 seconds"


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of a stream, below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/streams/{name}"


def with_event_time(df: DataFrame, column: str, delay: str, fallback: str | None = None) -> DataFrame:
    """Event time ``ts`` out of an epoch column in seconds or milliseconds, with a watermark.

    ``fallback`` is read where the column is null. A watermark needs a time; rows without one are given by
    :func:`without_event_time`.
    """
    timed = df.withColumn("ts", _event_time(column, fallback))
    return timed.where(F.col("ts").isNotNull()).withWatermark("ts", delay)


def without_event_time(df: DataFrame, column: str, fallback: str | None = None) -> DataFrame:
    """The rows that :func:`with_event_time` leaves out, as they came."""
    return df.where(_event_time(column, fallback).isNull())


def _event_time(column: str, fallback: str | None):
    value = F.col(column) if fallback is None else F.coalesce(F.col(column), F.col(fallback))
    return times.millis_to_timestamp(times.epoch_millis(value.cast("string")))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
    delay: str = LOG_DELAY,
    timed: bool = False,
) -> DataFrame:
    """Stream-stream twin of the batch interval join; the bounds let Spark drop old state.

    ``timed`` says that the left side has its watermark already, as the result of such a join has.
    """
    right_named = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    left_side = left if timed else left.withWatermark(left_ts, delay)
    right_side = right_named.withWatermark(right_ts, delay)
    keys = [F.col(c) == F.col(f"__r_{c}") for c in on]
    reach = F.expr(
        f"{right_ts} >= {left_ts} + INTERVAL {lower} SECONDS AND {right_ts} <= {left_ts} + INTERVAL {upper} SECONDS"
    )
    condition = reach
    for k in keys:
        condition = condition & k
    return left_side.join(right_side, condition).drop(*[f"__r_{c}" for c in on])


def user_label(devices: DataFrame, orders: DataFrame, profiles: DataFrame, delay: str = LOG_DELAY) -> DataFrame:
    """Device scores with order scores with profiles, as one stream of two interval joins."""
    scores = labels.label_scores_join(devices, orders, join=partial(interval_join, delay=delay))
    return labels.user_label(scores, profiles, join=partial(interval_join, delay=delay, timed=True))


def daily_distinct(df: DataFrame, key: list[str], ts: str = "ts") -> DataFrame:
    """First arriving row per key and day; state of a day is dropped one day after it ends."""
    day = df.withColumn("day", F.date_trunc("day", F.col(ts))).withWatermark("day", "1 day")
    return day.dropDuplicates([*key, "day"])


def traffic_window(flagged: DataFrame, width: str = "10 seconds", delay: str = LOG_DELAY) -> DataFrame:
    """Traffic summary over views that already carry uv_ct (:func:`millrace.streaming.state.first_of_day`).

    The flags come from a table between the two streams, as layers are chained by topics.
    """
    opens = (F.coalesce(F.col("last_page_id"), F.lit("")) == "").cast("bigint")
    windowed = flagged.withWatermark("ts", delay).groupBy(F.window("ts", width), *traffic.TRAFFIC_KEYS)
    total = windowed.agg(
        F.sum("uv_ct").alias("uv_ct"),
        F.sum(opens).alias("sv_ct"),
        F.count(F.lit(1)).alias("pv_ct"),
        F.sum("during_time").alias("dur_sum"),
    )
    return total.select(
        *times.window_bounds(F.col("window")), *traffic.TRAFFIC_KEYS, "uv_ct", "sv_ct", "pv_ct", "dur_sum"
    )


def keyword_window(views: DataFrame, width: str = "10 seconds", delay: str = SQL_DELAY) -> DataFrame:
    return traffic.keyword_window(views.withWatermark("ts", delay), width)


def query_count_window(searches: DataFrame, width: str = "3 seconds", delay: str = LOG_DELAY) -> DataFrame:
    windowed = searches.withWatermark("ts", delay).groupBy(F.window("ts", width), "query")
    return windowed.agg(F.count(F.lit(1)).alias("query_count"))


def hot_queries(searches: DataFrame, n: int = 10) -> DataFrame:
    """Running counts in complete mode; the sink sees the n largest after every batch."""
    counted = searches.groupBy("query").agg(F.count(F.lit(1)).alias("query_count"))
    return counted.orderBy(F.desc("query_count"), "query").limit(n)


# --- running a stream ----------------------------------------------------------------------------


def run_available(df: DataFrame, name: str, write: Callable[[DataFrame, int], None], mode: str = "append", wait: int | None = None, location: str | None = None) -> StreamingQuery:
    """Work off what the sources hold now, batch by batch, and return the ended query.

    It takes as long as that takes; with ``wait`` the stream is stopped after so many seconds with an error.
    """
    query = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", location or checkpoint_location(df.sparkSession, name))
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    if wait is None:
        query.awaitTermination()
    elif not query.awaitTermination(wait):
        query.stop()
        raise TimeoutError(f"stream {name} did not end within {wait} s")
    return query


def start(df: DataFrame, name: str, write: Callable[[DataFrame, int], None], mode: str = "append", every: str = "10 seconds") -> StreamingQuery:
    """Run continuously."""
    return (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
        .trigger(processingTime=every)
        .foreachBatch(write)
        .start()
    )


def upsert_into(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    return table.write_batch


def append_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own subfolder of its run, replacing an earlier attempt of the same batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/run={run_of(batch.sparkSession)}/batch={batch_id}")

    return write


def route_facts(config: Callable[[], DataFrame], folder: str) -> Callable[[DataFrame, int], None]:
    """Each batch of changes into one folder per sink table, by the configuration as it is at that time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = cdc.route_fact(batch, config())
        target = f"{folder}/run={run_of(batch.sparkSession)}/batch={batch_id}"
        routed.write.mode("overwrite").partitionBy("sink_table").parquet(target)

    return write


def upsert_dimensions(config: Callable[[], DataFrame], table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """Dimension rows of each batch of changes into a table keyed by (sink_table, row_key)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(cdc.dim_latest(batch, config()), batch_id)

    return write


def moderate(words: Callable[[], DataFrame], key: str, folder: str) -> Callable[[DataFrame, int], None]:
    """Each batch of comments with its grade, by the word table as it is at that time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        graded = moderation.comment_moderation(batch, words(), key)
        graded.write.mode("overwrite").parquet(f"{folder}/run={run_of(batch.sparkSession)}/batch={batch_id}")

    return write


def split_log_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """One parse, six sinks: dirty, err, start, display, action, page.

    The batch is cached while its outputs are written and released afterwards.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch.sparkSession)
        parsed = logs.parse_json(batch, schemas.PAGE_LOG).persist()
        try:
            good = logs.good_records(parsed)
            outputs = {
                "dirty": logs.dirty_records(parsed),
                "err": logs.split_err(good),
                "start": logs.split_start(good),
                "display": logs.split_display(good),
                "action": logs.split_action(good),
                "page": logs.split_page(good),
            }
            for name, rows in outputs.items():
                rows.write.mode("overwrite").parquet(f"{folder}/{name}/run={run}/batch={batch_id}")
        finally:
            parsed.unpersist()

    return write
