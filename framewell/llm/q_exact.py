"""Query of exact dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.exact import exact_groups


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256 FROM t WINDOW g AS (PARTITION BY t)
"""

QUERIES = {"op13_exact_dedup": (op13_exact_dedup, ORACLE)}
