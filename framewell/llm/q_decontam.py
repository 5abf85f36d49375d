"""Query of benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.decontam import contaminated


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Fingerprints have no SQL; tests hold the matches against brute force over all windows.
QUERIES = {"op3_benchmark_decontamination": (op3_benchmark_decontamination, None)}
