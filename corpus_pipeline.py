"""From raw documents to token ids: five stages, each written before the next one reads it.

1. Quality rules: documents that fail the base or that the fitted rules call bad go.
2. Near-duplicates by MinHash: the document with the smallest id of each group stays.
3. Secrets: what the forest calls a secret is masked in the text; no document goes.
4. Mixing: all documents are put in the order that gives each source its weight, block by block.
5. Byte-level BPE: token ids of every text.

The rows of a stage are judged on that stage's input alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_bpe, fast_minhash, quality_rules, secret_forest, source_mixing
from millrace.llm.tables import saved, table
from millrace.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_rules.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return fast_minhash.without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return secret_forest.masked(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return source_mixing.in_mixture_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, 32 bits) of every document."""
    configure(spark)
    return byte_bpe.encoded(docs).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality),
    ("minhash near-dedup", near_dedup),
    ("secret scan", secrets),
    ("source mixing", mixing),
    ("byte-level bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# Byte-level merges and the forest can't be stated in SQL; tests/llm checks the stages instead.
ORACLE_SQL = None
