"""Query of approximate nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.hnsw import build_index, search


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS v")
    return search(build_index(vectors, 5), vectors.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 5)


#: Approximate results have no SQL; tests measure recall and scores against brute force.
QUERIES = {"op1_nearest_neighbours": (op1_nearest_neighbours, None)}
