"""Query of the suffix-array dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm import suffix


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), length=100, keep_text=False)


#: The removal of covered bytes has no practical SQL over whole tables; tests hold it against brute force.
QUERIES = {"op4_suffix_array_dedup": (op4_suffix_array_dedup, None)}
