"""Query of training-order materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.order import materialise


def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]


#: Written shards have no SQL; tests read them back and compare every id with the tokenizer's.
QUERIES = {"op10_token_id_output": (op10_token_id_output, None)}
