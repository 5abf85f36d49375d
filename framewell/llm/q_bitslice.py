"""Query of ranked lexical search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.bitslice import ranked


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH a AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM a WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM b),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
qt AS (SELECT item_id, t, count(*)::BIGINT AS times FROM q GROUP BY 1, 2),
p AS (SELECT doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM b) WHERE t IN (SELECT t FROM qt) GROUP BY 1, 2, 3),
d AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM p, s GROUP BY t, docs),
r AS (SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score FROM qt JOIN p USING (t) JOIN d USING (t), s GROUP BY 1, 2),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0)
SELECT * FROM o WHERE rank <= 20
"""

QUERIES = {"op11_ranked_search": (op11_ranked_search, ORACLE)}
