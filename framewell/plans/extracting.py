"""Queries of batch extractors and of the paged source."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import extractors as X
from framewell.plans.common import table
from framewell.sources import files as S
from framewell.sources import pages as P
from framewell.streaming import jobs as J


def x02_text_batches(spark, sf):
    name = X.register_extractor(spark, X.TextShape())
    table(spark, sf, "documents").createOrReplaceTempView("framewell_documents")
    return spark.sql(f"SELECT CAST(key AS bigint) AS doc_id, feature, round(value, 9) AS value FROM {name}(TABLE(SELECT doc_id, text FROM framewell_documents)) WHERE error IS NULL")


def x03_signal_segments(spark, sf):
    """Each user's values, less 20, as a signal of two a second, in segments of up to eight that a LATERAL join makes."""
    name = X.register_extractor(spark, X.SignalShape())
    e = table(spark, sf, "events").where("user_id IS NOT NULL AND value IS NOT NULL")
    e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda x: x["value"] - 20).alias("signal")).createOrReplaceTempView("framewell_signals")
    segments = "SELECT user_id, s.col AS segment, slice(signal, s.col * 8 + 1, 8) AS piece, 2.0D AS rate FROM framewell_signals, LATERAL explode(sequence(0, CAST(floor((size(signal) - 1) / 8) AS int))) s"
    return spark.sql(f"SELECT CAST(key AS bigint) AS user_id, segment, feature, round(value, 7) AS value FROM {name}(TABLE({segments})) WHERE error IS NULL")


def x04_discovery_pages(spark, sf):
    """Orders of each day, as they are discovered, in pages of 2,000; two runs of one stream, the second after more pages have come."""
    path, out = S.scratch(spark), S.scratch(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey").where("o_orderkey IS NOT NULL")
    half = o.where("o_orderkey % 2 = 0")
    P.write_pages(half, ["o_orderkey"], 2000, path)
    J.run_confirmed(P.page_stream(spark, path, "o_orderkey long, o_custkey long"), out)
    P.write_pages(o.where("o_orderkey % 2 <> 0"), ["o_orderkey"], 2000, path, -(-half.count() // 2000))
    return J.run_confirmed(P.page_stream(spark, path, "o_orderkey long, o_custkey long"), out).select("o_orderkey", "o_custkey", "page")


QUERIES = {
    "x02_text_batches": (x02_text_batches, r"WITH d AS (SELECT doc_id, text, length(text)::DOUBLE n FROM documents WHERE text IS NOT NULL) SELECT * FROM (SELECT doc_id, unnest(['characters','words','digits','capitals']) feature, unnest([n, len(regexp_extract_all(text, '[^ \t\n\r\x0b\x0c]+'))::DOUBLE, round(len(regexp_extract_all(text,'[0-9]'))/nullif(n,0),9), round(len(regexp_extract_all(text,'[A-Z]'))/nullif(n,0),9)]) AS value FROM d) WHERE value IS NOT NULL"),
    "x03_signal_segments": (x03_signal_segments, "WITH e AS (SELECT user_id, value-20 v, row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1 i FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL), s AS (SELECT user_id, i//8 segment, v, (v<0) <> lag(v<0) OVER (PARTITION BY user_id, i//8 ORDER BY i) turn FROM e), g AS (SELECT user_id, segment, sqrt(avg(v*v)) rms, max(abs(v)) peak, coalesce(sum(turn::INT),0)*2.0/count(*) crossings FROM s GROUP BY ALL) SELECT user_id, segment::INT segment, unnest(['rms','peak','crossings']) feature, unnest([round(rms,7),round(peak,7),round(crossings,7)]) AS value FROM g"),
    "x04_discovery_pages": (x04_discovery_pages, "WITH h AS (SELECT ceil(count(*)/2000.0)::BIGINT h FROM orders WHERE o_orderkey%2=0) SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey%2=0 THEN 0 ELSE h END + (row_number() OVER (PARTITION BY o_orderkey%2 ORDER BY o_orderkey)-1)//2000 AS page FROM orders, h"),
}
