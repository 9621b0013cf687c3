"""Comment moderation: blacklist on the last part, dictionary words anywhere in the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import texts, times
from millrace.operators.dedup import dedup_pair
from millrace.operators.joins import broadcast_if_small, spread_lookup


def word_table(words: DataFrame, column: str = "word") -> DataFrame:
    """Different non-empty words in lower case."""
    lowered = F.lower(F.trim(F.col(column))).alias("word")
    return words.select(lowered).where(F.col("word") != "").distinct()


def comment_blacklist(comments: DataFrame, words: DataFrame, text: str = "msg") -> DataFrame:
    """Flag comments whose last comma part is a blacklisted word."""
    listed = words.select("word", F.lit(True).alias("__listed"))
    # A text without a last part has no key; the lookup deals those rows over all partitions.
    part = F.coalesce(texts.last_part(F.col(text)), F.lit(""))
    keyed = comments.withColumn("last_word", part).withColumn("__last", F.nullif(F.lower("last_word"), F.lit("")))
    flagged = spread_lookup(keyed, listed, {"__last": "word"}, {"__listed": "__listed"})
    return flagged.withColumn("is_violation", F.col("__listed").isNotNull().cast("bigint")).drop("__listed", "__last")


def _letters(text: Column) -> Column:
    return F.split(text, "")


def _gram_hashes(letters: Column, levels: Column) -> Column:
    """For each level l from 0 to ``levels``: the different hashes of runs of 2^l letters, as (level, hashes).

    The hash of a run comes from the hashes of its two halves, so a level costs one step per letter.
    """
    start = F.struct(
        F.transform(letters, lambda c: F.xxhash64(c)).alias("h"), F.array().cast("array<struct<level:int,hashes:array<bigint>>>").alias("out")
    )

    def step(s: Column, level: Column) -> Column:
        half = F.pow(F.lit(2), level).cast("int")
        # Computed once per level, not per letter.
        longer = F.transform(
            F.array(F.struct(half.alias("half"), (F.size(s["h"]) - half).alias("n"))),
            lambda v: F.when(
                v["n"] > 0,
                F.transform(F.sequence(F.lit(0), v["n"] - 1), lambda i: F.xxhash64(F.get(s["h"], i), F.get(s["h"], i + v["half"]))),
            ).otherwise(F.array().cast("array<bigint>")),
        )[0]
        found = F.struct(level.alias("level"), F.array_distinct(s["h"]).alias("hashes"))
        return F.struct(longer.alias("h"), F.concat(s["out"], F.array(found)).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), levels), start, step, lambda s: s["out"])


def dictionary_hits(comments: DataFrame, words: DataFrame, key: str, text: str = "msg") -> DataFrame:
    """Different dictionary words found anywhere in each text, as a sorted comma list.

    Words fall into classes by length: class l holds the words of 2^l to 2^(l+1) - 1 letters. A text is cut into
    letters once; per class its different runs of 2^l letters are hashed, in time that grows with the text, and
    meet the first 2^l letters of the class's words. What meets is confirmed in the text, which is carried once per
    text and word. Only (key, class, hash) moves, and not even that where the measured dictionary is small enough
    to be broadcast.
    """
    letters = _letters(F.col("word"))
    level = F.floor(F.log2(F.size(letters))).cast("int")
    hashed = F.element_at(_gram_hashes(F.slice(letters, F.lit(1), F.pow(F.lit(2), level).cast("int")), level), -1)["hashes"][0]
    entries = words.where(F.length("word") > 0).select("word", level.alias("__level"), hashed.alias("__hash"))
    deepest = entries.agg(F.max("__level").alias("l")).scalar()
    low = F.lower(F.col(text))
    texts_of = comments.where(F.length(F.col(text)) > 0).select(F.col(key).alias("__key"), low.alias("__text"))
    # Dealt by key first: the work per text is spread however the texts are stored, and the join back needs no more.
    # Of few bytes is much work made, so partitions aren't merged by their size.
    texts_of = texts_of.repartition(int(comments.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__key")
    # A subquery may not stand inside a lambda, so its value is a column first.
    levelled = texts_of.withColumn("__deepest", F.coalesce(deepest, F.lit(0)))
    levels = levelled.select("__key", F.explode(_gram_hashes(_letters(F.col("__text")), F.col("__deepest"))).alias("__g"))
    grams = levels.select("__key", F.col("__g.level").alias("__level"), F.explode("__g.hashes").alias("__hash"))
    met = grams.join(broadcast_if_small(entries), ["__level", "__hash"]).select("__key", "word")
    found = met.join(texts_of, "__key").where(F.contains("__text", "word"))
    hits = found.groupBy("__key").agg(F.array_join(F.array_sort(F.collect_set("word")), ",").alias("hits"))
    return hits.select(F.col("__key").alias(key), "hits")


def comment_moderation(comments: DataFrame, words: DataFrame, key: str, text: str = "msg") -> DataFrame:
    """Two levels: P0 for a blacklisted last part, otherwise P1 for dictionary words in the text.

    P0 is never overwritten by P1.
    """
    first = comment_blacklist(comments, words, text)
    hits = dictionary_hits(first.where(F.col("is_violation") == 0), words, key, text)
    both = first.join(hits, [key], "left")
    p0 = F.col("is_violation") == 1
    grade = F.when(p0, "P0").when(F.col("hits").isNotNull(), "P1").otherwise("")
    message = F.when(p0, F.col("last_word")).otherwise(F.coalesce(F.col("hits"), F.lit("")))
    return both.select(
        *comments.columns,
        "is_violation",
        grade.alias("violation_grade"),
        message.alias("violation_msg"),
    )


def ban_list(comments: DataFrame, words: DataFrame) -> DataFrame:
    """Comments once per order and time, moderated, with the user and the day."""
    once = dedup_pair(comments, "order_id", "ts", ["id"])
    graded = comment_moderation(once, words, "id")
    return graded.select(
        "id",
        "user_id",
        "consignee",
        "ts",
        times.day_stamp(F.col("ts")).alias("ds"),
        "msg",
        "is_violation",
        "violation_grade",
        "violation_msg",
    )
