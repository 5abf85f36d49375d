"""Query of greedy word-piece counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.wordpiece import token_counts


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Longest match against a vocabulary has no practical SQL; tests hold it against a plain greedy matcher.
QUERIES = {"op2_token_counts": (op2_token_counts, None)}
