"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    byte_bpe, fast_minhash, host_suffixes, lexical_search, prefix_trie, quality_rules, secret_forest, sharding, source_mixing,
    subspace_join, token_counts, tool_calls, warc_zip,
)
from millrace.llm.tables import table

TOKEN_LIMIT = 4096

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("quality", 6).alias("quality"),
    )


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing.mixed(table(spark, folder, "documents"))


def op3_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, folder, "pages"), least=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_forest.findings(table(spark, folder, "documents")).select(
        "doc_id", "at", F.col("core").alias("finding"), F.round("probability", 6).alias("probability"), "is_secret"
    )


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return subspace_join.near_vectors(table(spark, folder, "embeddings"))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fast_minhash.near_duplicates(table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, folder, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encoded(table(spark, folder, "documents")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = host_suffixes.main_text(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


TOOLS = {
    "lookup": {"key": {"type": "string", "required": True}, "of": {"type": "string"}},
    "search": {
        "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 10},
        "query": {"type": "string", "required": True},
    },
    "translate": {
        "lang": {"type": "string", "required": True, "enum": ["de", "en", "es", "fr"]},
        "text": {"type": "string", "required": True},
    },
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as an agent's log: each assistant turn asks for a tool, the user's next one answers.

    The tool and its arguments follow from the turn's whole text. A third of the calls looks something up that
    an earlier call of the conversation gave, where there is one. Some arguments break the tool's schema.
    """
    n = F.length("text")
    call_id = F.concat_ws("_", F.lit("call"), F.col("conv_id"), F.col("turn"))
    earlier = F.when(
        F.floor(F.col("turn") / 2) % 3 != 0, F.concat_ws("_", F.lit("$ref:call"), F.col("conv_id"), F.col("turn") - 2)
    )
    search = F.to_json(F.struct((n % 13).alias("limit"), F.col("text").alias("query")))
    lookup = F.to_json(F.struct(F.md5(F.col("text").cast("binary")).alias("key"), earlier.alias("of")))
    lang = F.element_at(F.array(*map(F.lit, ["de", "en", "es", "fr", "xx"])), (n % 5 + 1).cast("int"))
    translate = F.to_json(F.struct(F.col("text"), lang.alias("lang")))
    kind = n % 3
    call = F.concat(
        F.lit('[{"id":"'), call_id, F.lit('","name":"'),
        F.when(kind == 0, "search").when(kind == 1, "lookup").otherwise("translate"), F.lit('","arguments":'),
        F.when(kind == 0, search).when(kind == 1, lookup).otherwise(translate), F.lit("}]"),
    )
    asks = F.col("role") == "assistant"
    answers = (F.col("role") == "user") & (F.col("turn") > 0)
    answered = F.when(n % 7 == 0, F.lit("none")).otherwise((F.col("turn") - 1).cast("string"))
    return conversations.select(
        "conv_id", "turn", F.when(answers, "tool").otherwise(F.col("role")).alias("role"),
        F.when(~asks | (kind == 1), F.col("text")).alias("content"), F.when(asks, call).alias("tool_calls"),
        F.when(answers, F.concat_ws("_", F.lit("call"), F.col("conv_id"), answered)).alias("tool_call_id"),
    )


def op10_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.formatted(tool_messages(table(spark, folder, "conversations")), TOOLS)


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.sharded(table(spark, folder, "documents"), shards=8)
    return dealt.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mixing": op2_source_mixing,
    "op3_warc_zip": op3_warc_zip,
    "op4_secret_scan": op4_secret_scan,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_html_text": op9_html_text,
    "op10_tool_calls": op10_tool_calls,
    "op11_lexical_search": op11_lexical_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sharding": op13_sharding,
}
