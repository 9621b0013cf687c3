"""Whole-table reports: buckets, keys, filled days, character quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import keys, texts


def hash_bucket_skew(df: DataFrame, key: Column, buckets: int = 128) -> DataFrame:
    """Rows per hash bucket and their ratio to the mean of the buckets in use.

    The ratio looks at one row per bucket, so its single partition is bounded by ``buckets``.
    """
    counted = df.groupBy(keys.hash_bucket(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    mean = F.avg(F.col("row_count").cast("double")).over(Window.partitionBy())
    return counted.select("bucket", "row_count", F.round(F.col("row_count") / mean, 4).alias("skew"))


def row_key_duplicates(keyed: DataFrame, key: str = "row_key") -> DataFrame:
    """Keys that occur more than once."""
    return (
        keyed.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def daily_metric_filled(metric: DataFrame, day: str, keys_: list[str], values: list[str]) -> DataFrame:
    """A daily metric with a row for every day between its first and last, missing days as 0.

    ``metric`` has one row per day and key. Each key gets its own days, from one aggregate row.
    """
    spine = metric.groupBy(*keys_).agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    days = spine.select(*keys_, F.explode(F.sequence("__lo", "__hi")).alias(day))
    joined = days.join(metric, [*keys_, day], "left")
    return joined.select(*keys_, day, *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


def text_charset_quality(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Share of texts, and of blank-separated tokens, that consist of clean characters only."""
    tokens = F.filter(F.split(F.col(text), "\\s+"), lambda t: t != "")
    clean = F.filter(tokens, texts.is_clean)
    counted = df.select(
        *by,
        texts.is_clean(F.col(text)).cast("bigint").alias("ok"),
        F.size(tokens).cast("bigint").alias("tokens"),
        F.size(clean).cast("bigint").alias("clean_tokens"),
    )
    total = counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("text_count"),
        F.sum("ok").alias("clean_texts"),
        F.sum("tokens").alias("token_count"),
        F.sum("clean_tokens").alias("clean_tokens"),
    )
    def share(part: str, whole: str) -> Column:
        return F.when(
            F.col(whole) > 0, F.round(F.col(part).cast("double") / F.col(whole).cast("double"), 6)
        ).otherwise(F.lit(0.0))

    return total.select(
        *by,
        "text_count",
        "clean_texts",
        "token_count",
        "clean_tokens",
        share("clean_texts", "text_count").alias("text_share"),
        share("clean_tokens", "token_count").alias("token_share"),
    )
