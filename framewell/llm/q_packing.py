"""Query of best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.packing import pack_documents


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), capacity=1024)


#: Byte-level BPE has no SQL; tests hold ids, lengths and the packing against brute force.
QUERIES = {"op7_best_fit_packing": (op7_best_fit_packing, None)}
