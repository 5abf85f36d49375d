"""Query of phrase collocations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.collocations import collocations


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1 HAVING sum(len(w)) > 0),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i : i + 1], ' '))) FROM w WHERE len(w) > 1
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) FROM w WHERE len(w) > 2),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS j FROM c),
x AS (SELECT s.lang, s.phrase, s.a, j, x.a AS l, y.a AS r, ((1000000::HUGEINT * s.a * s.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM s JOIN f x ON x.lang = s.lang AND x.phrase = array_to_string(w[1 : j], ' ') JOIN f y ON y.lang = s.lang AND y.phrase = array_to_string(w[j + 1 : s.k], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
t AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY 1, 2),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b LEFT JOIN t ON t.lang = b.lang AND t.phrase = b.phrase WHERE coalesce(100 * longer < 50 * a, true))
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""

QUERIES = {"op12_phrase_collocations": (op12_phrase_collocations, ORACLE)}
