"""Query of language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.llm.language import fit, held_out, identify


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs, ~held_out())
    named = identify(docs.select("doc_id", "text"), model)
    return named.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


#: Trained embeddings have no SQL; tests measure held-out accuracy.
QUERIES = {"op9_language_id": (op9_language_id, None)}
