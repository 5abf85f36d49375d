"""Query of license scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.licenses import COVER, DRIFT, GRAM, NOTICES, PHRASES, license_digest


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_VALUES = ", ".join(f"({n}, '{b}', '{label}', {exact})" for n, (b, label, exact) in enumerate([(*p, True) for p in PHRASES] + [(*x, False) for x in NOTICES]))
ORACLE = rf"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), t AS (SELECT * FROM (VALUES {_VALUES}) t(template, body, label, exact)),
tw AS (SELECT *, string_split(body, ' ') AS b FROM t),
tg AS (SELECT template, label, exact, len(b) - {GRAM - 1} AS grams, unnest(range(len(b) - {GRAM - 1})) AS place, b FROM tw),
tm AS (SELECT *, array_to_string(b[place + 1 : place + {GRAM}], ' ') AS gram FROM tg),
g AS (SELECT doc_id, w, unnest(range(greatest(len(w) - {GRAM - 1}, 0))) AS pos FROM w),
h AS (SELECT doc_id, template, label, exact, grams, place, pos, pos - place AS diagonal FROM g JOIN tm ON array_to_string(w[pos + 1 : pos + {GRAM}], ' ') = gram),
v AS (SELECT doc_id, template, label, exact, grams, diagonal, list(DISTINCT place) AS places, min(pos) AS lo, max(pos) AS hi FROM h GROUP BY ALL),
p AS (SELECT doc_id, label, exact, diagonal AS b, 1.0::DOUBLE AS share FROM v WHERE exact AND len(places) = grams),
l AS (SELECT *, CASE WHEN abs(diagonal - lag(diagonal) OVER r) <= {DRIFT} AND lo - lag(hi) OVER r <= grams THEN 0 ELSE 1 END AS new FROM v WHERE NOT exact WINDOW r AS (PARTITION BY doc_id, template ORDER BY lo, diagonal)),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY lo, diagonal) AS span FROM l),
m AS (SELECT doc_id, template, label, exact, len(list_distinct(flatten(list(places)))) / grams AS share, min(lo) AS a, max(hi) + {GRAM - 1} AS z FROM s GROUP BY doc_id, template, label, exact, grams, span),
o AS (SELECT *, CASE WHEN a > max(z) OVER (PARTITION BY doc_id ORDER BY a, z, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS apart FROM m WHERE share >= {COVER}),
k AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id ORDER BY a, z, template ROWS UNBOUNDED PRECEDING) AS heap FROM o),
x AS (SELECT *, max(share) OVER (PARTITION BY doc_id, heap) AS best FROM k),
f AS (SELECT doc_id, label, exact, b, share FROM p UNION ALL SELECT doc_id, label, exact, NULL, share FROM x WHERE share = best),
d AS (SELECT doc_id, count(b) AS n_base, min(b) AS first_word, max(b) AS last_word, coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (exact)), ','), '') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score FROM f GROUP BY 1)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM w LEFT JOIN d USING (doc_id)
"""

QUERIES = {"op6_license_scan": (op6_license_scan, ORACLE)}
