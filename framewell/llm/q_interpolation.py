"""Query of language-model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.interpolation import score_documents
from framewell.llm.language import held_out


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_documents(docs, ~held_out("doc_id", 7, 2))


#: Weights learned by EM have no SQL; tests hold counts, base scores and scores against a plain Python version.
QUERIES = {"op8_lm_scoring": (op8_lm_scoring, None)}
