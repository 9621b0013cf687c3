"""Functions for SQL users. Their bodies are SQL expressions, so they run inside the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_functions(spark: SparkSession) -> None:
    """Temporary functions of the session: ``keywordUDTF(text)`` gives one row per word."""
    spark.sql(
        r"""
        CREATE OR REPLACE TEMPORARY FUNCTION keywordUDTF(phrase STRING)
        RETURNS TABLE (word STRING)
        RETURN SELECT w.word
               FROM explode(filter(split(lower(phrase), '[^\\p{L}\\p{N}]+'), x -> x <> '')) AS w(word)
        """
    )
