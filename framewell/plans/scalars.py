"""Queries of single functions, summaries and vector pairs that other queries use as helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import values as V
from framewell.operators import profile as P
from framewell.operators import rules as R
from framewell.operators import stateful as S
from framewell.operators import vectors as X
from framewell.plans.common import table


def f04_close(spark, sf):
    i = table(spark, sf, "lineitem").withColumn("other", F.col("l_extendedprice") * (1 + (F.col("l_linenumber") - 4) * 5e-5))
    return i.groupBy(V.close("l_extendedprice", "other").alias("close")).agg(F.count("*").alias("n"))


def f08_lenient_bigint(spark, sf):
    k = F.col("c_custkey")
    text = F.when(k % 5 == 0, k.cast("string")).when(k % 5 == 1, F.lit("12.7")).when(k % 5 == 2, F.concat(F.lit("  -"), k.cast("string"), F.lit(" "))).when(k % 5 == 3, F.lit("x1"))
    return table(spark, sf, "customer").select("c_custkey", V.lenient_bigint(text).alias("n"), V.truncated_bigint("c_acctbal").alias("whole"))


def f10_parse_stamp(spark, sf):
    k = F.col("o_orderkey")
    text = F.when(k % 7 == 0, "2020_13_01_00_00").when(k % 2 == 0, F.date_format("o_orderdate", "yyyy_MM_dd_HH_mm")).otherwise(F.date_format("o_orderdate", "yyyy_MM_dd_HH_mm_ss"))
    return table(spark, sf, "orders").select("o_orderkey", V.parse_stamp(text).cast("string").alias("at"))


def f11_age_hours(spark, sf):
    now = F.expr("timestamp'1995-06-17'")
    return table(spark, sf, "orders").select("o_orderkey", F.round(V.age_hours(now, "o_orderdate"), 3).alias("clipped"), F.round(V.age_hours(now, "o_orderdate", False), 3).alias("plain"))


def f13_next_due(spark, sf):
    offsets = spark.createDataFrame([(0, 0), (1, 168), (2, 336), (3, 504)], "i int, hours int")
    done = table(spark, sf, "orders").groupBy("o_custkey", (F.col("o_orderkey") % 4).cast("int").alias("i")).agg(F.max("o_orderdate").alias("at"))
    return S.reanchor(offsets, done, "o_custkey", "i", "hours", "at").select("o_custkey", "i", F.col("due").cast("string").alias("due"))


def f26_unit_hash(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.round(V.unit_hash("c_name"), 9).alias("u"))


def a02_summary_with_p10(spark, sf):
    out = P.array_summary(table(spark, sf, "orders").select("o_orderpriority", F.col("o_totalprice").alias("value")), ["o_orderpriority"])
    return out.select("o_orderpriority", "n", *(F.round(c, 3).alias(c) for c in ("mean", "std", "p10", "p50", "p90")))


def a03_simple_stats(spark, sf):
    out = P.array_summary(table(spark, sf, "events").select("event_type", "value"), ["event_type"])
    return out.select("event_type", *(F.round(c, 4).alias(n) for c, n in (("mean", "mean"), ("std", "std"), ("min", "lo"), ("max", "hi"), ("p50", "median"))))


def p16_rule_resolution(spark, sf):
    i = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("component"), *(F.col(c).cast("string").alias(c) for c in ("l_quantity", "l_discount", "l_tax")))
    long = i.unpivot(["component"], ["l_quantity", "l_discount", "l_tax"], "column", "raw")
    rules = spark.createDataFrame([(None, "l_quantity", None, 1.0, 45.0), ("R", "l_quantity", None, 1.0, 40.0), (None, None, "^l_(discount|tax)$", 0.0, 0.07), ("N", None, "^l_tax$", 0.0, 0.01)], "component string, column string, pattern string, lo double, hi double")
    rules = rules.withColumns({"allowed": F.lit(None).cast("array<string>"), "optional": F.lit(False)})
    return R.apply_rules(long, rules).groupBy("component", "column", "warning").agg(F.count("*").alias("n"))


def j06_batch_drift(spark, sf):
    long = P.to_long(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_tax"])
    a = long.where("l_returnflag IN ('A', 'R') AND feature <> 'l_tax'").drop("l_returnflag")
    b = long.where("l_returnflag IN ('N', 'R') AND feature <> 'l_extendedprice'").drop("l_returnflag")
    return P.drift(a, b, ["feature"]).select("feature", *(F.round(c, 5).alias(c) for c in ("mean_a", "mean_b", "mean_diff", "coverage_a", "coverage_b")))


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").where("embedding IS NOT NULL")


def j15_gallery_top_k(spark, sf):
    """The stated query set, ids divisible by 20, against all rows but the query's own."""
    e = _vectors(spark, sf)
    q = e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return X.top_k_cosine_all(q, e, "query_id", "vec_id", "embedding", 3, True).select("query_id", "rank", "vec_id")


def v06_inner_product(spark, sf):
    e = _vectors(spark, sf)
    q = e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return X.top_k_cosine_all(q, e, "query_id", "vec_id", "embedding", 4, False, False).select("query_id", "rank", F.round("score", 4).alias("score"))


def j16_mean_similarity(spark, sf):
    return X.mean_similarity(_vectors(spark, sf), ["label"], "vec_id", "embedding").select("label", "vec_id", F.round("mean_similarity", 5).alias("mean_similarity"))


def a34_scene_vectors(spark, sf):
    """Scenes of 25 frames; a missing component is left out of its mean."""
    e = _vectors(spark, sf).select(F.expr("vec_id div 25").alias("scene"), F.transform("embedding", lambda x, i: F.when((i == 0) & (F.col("vec_id") % 7 == 0), F.lit(None)).otherwise(x)).alias("v"))
    return X.mean_vector(e, ["scene"], "v").select("scene", *(F.round(F.col("vector")[i], 5).alias(f"x{i}") for i in (0, 1, 6)))


def v03_cosine_pairs(spark, sf):
    e = _vectors(spark, sf).select(F.expr("vec_id div 3").alias("doc"), F.col("vec_id") % 3, "embedding").toDF("doc", "part", "v")
    packs = e.groupBy("doc").pivot("part", [0, 1, 2]).agg(F.first("v")).toDF("doc", "title", "description", "transcript")
    return X.cosine_pairs(packs, ["doc"], ["title", "description", "transcript"]).select("doc", *(F.round(c, 6).alias(c) for c in ("title_description", "title_transcript", "description_transcript")))


def v05_title_hashtags(spark, sf):
    e = _vectors(spark, sf).select(F.expr("vec_id div 6").alias("doc"), (F.col("vec_id") % 6 == 0).alias("title"), "embedding")
    return X.cosine_to_mean(e.where("title"), e.where("NOT title"), ["doc"], "embedding").select("doc", "n_many", F.round("cosine", 5).alias("cosine"))


def l13_validators(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_extendedprice", "l_tax")
    out = R.validate(i, ["l_orderkey"], [("l_quantity", 1.0, 45.0, "error"), ("l_discount", 0.0, 0.08, "warning")], [("price_of_quantity", "info", F.col("l_extendedprice") > 1000 * F.col("l_quantity")), ("tax_without_discount", "warning", (F.col("l_discount") == 0) & (F.col("l_tax") > 0.07))])
    return out.groupBy("feature", "severity").agg(F.count("*").alias("n"), F.round(F.max("value"), 4).alias("worst"))


def l14_emotion_summary(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL").withColumns({"valence": (F.col("event_id") % 21 - 10) / 10.0, "arousal": (F.col("event_id") * 7 % 23 - 11) / 11.0})
    e = e.withColumn("chances", F.create_map(F.lit("Fear"), (F.col("event_id") % 3) / 10.0, F.lit("Happy"), (F.col("event_id") % 5) / 10.0, F.lit("Sad"), F.when(F.col("event_id") % 2 == 0, 0.25)))
    return P.emotion_summary(e, ["user_id"]).select("user_id", "n", *(F.round(c, 6).alias(c) for c in ("stress", "confidence", "tension", "nervousness")))


_COS = "list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_EMO = """WITH e AS (SELECT user_id, (event_id%21-10)/10.0::DOUBLE v, (event_id*7%23-11)/11.0::DOUBLE a, (event_id%3)/10.0::DOUBLE fear, (event_id%5)/10.0::DOUBLE happy, CASE WHEN event_id%2=0 THEN 0.25::DOUBLE ELSE 0 END sad FROM events WHERE user_id IS NOT NULL),
g AS (SELECT user_id, count(*) n, (var_pop(v)+var_pop(a))/2 s, avg((a>0.3 AND v<0)::INT) low, avg(fear) fear, avg((v>0.2)::INT) pos, avg((a>-0.2 AND a<0.5)::INT) mid, avg(happy) happy, avg((a>0.4)::INT) high, avg(sad+fear) neg FROM e GROUP BY 1)
SELECT user_id, n, round((low+fear+least(1,2*s))/3,6) stress, round((pos+mid+happy+1-least(1,s))/4,6) confidence, round((high+1-least(1,2*s)+neg)/3,6) tension, round((least(1,3*s)+high+fear)/3,6) nervousness FROM g"""
QUERIES = {
    "f04_close": (f04_close, "SELECT abs(l_extendedprice-o)<=1e-5+1e-4*abs(o) AS close, count(*) n FROM (SELECT l_extendedprice, l_extendedprice*(1+(l_linenumber-4)*5e-5::DOUBLE) o FROM lineitem) GROUP BY 1"),
    "f08_lenient_bigint": (f08_lenient_bigint, "SELECT c_custkey, CASE c_custkey%5 WHEN 0 THEN c_custkey WHEN 2 THEN -c_custkey END n, trunc(c_acctbal)::BIGINT whole FROM customer"),
    "f10_parse_stamp": (f10_parse_stamp, "SELECT o_orderkey, CASE WHEN o_orderkey%7<>0 THEN strftime(CASE WHEN o_orderkey%2=0 THEN date_trunc('minute',o_orderdate) ELSE date_trunc('second',o_orderdate) END,'%Y-%m-%d %H:%M:%S') END AS at FROM orders"),
    "f11_age_hours": (f11_age_hours, "WITH a AS (SELECT o_orderkey, (epoch_us(TIMESTAMP '1995-06-17')-epoch_us(o_orderdate))/3.6e9 h FROM orders) SELECT o_orderkey, round(greatest(h,0),3) clipped, round(h,3) plain FROM a"),
    "f13_next_due": (f13_next_due, "WITH d AS (SELECT o_custkey, o_orderkey%4 i, max(o_orderdate) t FROM orders GROUP BY ALL), l AS (SELECT o_custkey, max(i) i, arg_max(t,i) t FROM d GROUP BY 1) SELECT o_custkey, (i+1)::INT i, strftime(t+INTERVAL 168 HOUR,'%Y-%m-%d %H:%M:%S') due FROM l WHERE i<3"),
    "f26_unit_hash": (f26_unit_hash, "SELECT c_custkey, round(('0x'||substr(sha256(c_name),1,16))::UBIGINT::DOUBLE/18446744073709551616.0,9) u FROM customer"),
    "a02_summary_with_p10": (a02_summary_with_p10, "SELECT o_orderpriority, count(*) n, round(avg(o_totalprice),3) mean, round(stddev_pop(o_totalprice),3) std, round(quantile_cont(o_totalprice,0.1),3) p10, round(quantile_cont(o_totalprice,0.5),3) p50, round(quantile_cont(o_totalprice,0.9),3) p90 FROM orders GROUP BY 1"),
    "a03_simple_stats": (a03_simple_stats, "SELECT event_type, round(avg(value),4) mean, round(stddev_pop(value),4) std, round(min(value),4) lo, round(max(value),4) hi, round(median(value),4) median FROM events GROUP BY 1"),
    "p16_rule_resolution": (p16_rule_resolution, """WITH l AS (SELECT l_returnflag component, unnest(['l_quantity','l_discount','l_tax']) AS "column", unnest([l_quantity,l_discount,l_tax]) v FROM lineitem), h AS (SELECT *, CASE "column" WHEN 'l_quantity' THEN CASE component WHEN 'R' THEN 40 ELSE 45 END WHEN 'l_tax' THEN CASE component WHEN 'N' THEN 0.01 ELSE 0.07 END ELSE 0.07 END hi, CASE "column" WHEN 'l_quantity' THEN 1 ELSE 0 END lo FROM l)
      SELECT component, "column", CASE WHEN v<lo OR v>hi::DOUBLE THEN 'out_of_range' END warning, count(*) n FROM h GROUP BY ALL"""),
    "j06_batch_drift": (j06_batch_drift, "WITH a AS (SELECT avg(l_quantity) m FROM lineitem WHERE l_returnflag IN ('A','R')), b AS (SELECT avg(l_quantity) m FROM lineitem WHERE l_returnflag IN ('N','R')) SELECT 'l_quantity' feature, round(a.m,5) mean_a, round(b.m,5) mean_b, round(b.m-a.m,5) mean_diff, 1.0::DOUBLE coverage_a, 1.0::DOUBLE coverage_b FROM a, b"),
    "j15_gallery_top_k": (j15_gallery_top_k, f"WITH s AS (SELECT a.vec_id query_id, b.vec_id, round({_COS},12) s FROM embeddings a JOIN embeddings b ON a.vec_id<>b.vec_id WHERE a.vec_id%20=0) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id)::INT AS rank, vec_id FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id)<=3"),
    "v06_inner_product": (v06_inner_product, "WITH s AS (SELECT a.vec_id query_id, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) s FROM embeddings a, embeddings b WHERE a.vec_id%20=0) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC)::INT AS rank, round(s,4) score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC)<=4"),
    "j16_mean_similarity": (j16_mean_similarity, f"SELECT a.label, a.vec_id, round(avg({_COS}),5) mean_similarity FROM embeddings a JOIN embeddings b ON a.label=b.label AND a.vec_id<>b.vec_id GROUP BY 1,2 UNION ALL SELECT label, min(vec_id), NULL FROM embeddings GROUP BY 1 HAVING count(*)=1"),
    "a34_scene_vectors": (a34_scene_vectors, """WITH c AS (SELECT vec_id//25 scene, vec_id, generate_subscripts(embedding,1)-1 d, unnest(embedding)::DOUBLE x FROM embeddings), m AS (SELECT scene, d, avg(CASE WHEN d=0 AND vec_id%7=0 THEN NULL ELSE x END) x FROM c GROUP BY ALL), n AS (SELECT scene, sqrt(sum(x*x)) n FROM m GROUP BY 1)
      SELECT scene, round(max(x/n) FILTER (d=0),5) x0, round(max(x/n) FILTER (d=1),5) x1, round(max(x/n) FILTER (d=6),5) x6 FROM m JOIN n USING (scene) GROUP BY 1"""),
    "v03_cosine_pairs": (v03_cosine_pairs, "WITH p AS (SELECT vec_id//3 doc, max(embedding::DOUBLE[]) FILTER (vec_id%3=0) a, max(embedding::DOUBLE[]) FILTER (vec_id%3=1) b, max(embedding::DOUBLE[]) FILTER (vec_id%3=2) c FROM embeddings GROUP BY 1) SELECT doc, round(list_cosine_similarity(a,b),6) title_description, round(list_cosine_similarity(a,c),6) title_transcript, round(list_cosine_similarity(b,c),6) description_transcript FROM p"),
    "v05_title_hashtags": (v05_title_hashtags, """WITH u AS (SELECT vec_id//6 doc, vec_id, generate_subscripts(embedding,1) d, unnest(embedding)::DOUBLE x, sqrt(list_inner_product(embedding::DOUBLE[],embedding::DOUBLE[])) n FROM embeddings), m AS (SELECT doc, d, avg(x/n) x FROM u WHERE vec_id%6<>0 GROUP BY ALL), k AS (SELECT vec_id//6 doc, count(*) n FROM embeddings WHERE vec_id%6<>0 GROUP BY 1),
      j AS (SELECT t.doc, sum(t.x*m.x)/(sqrt(sum(t.x*t.x))*sqrt(sum(m.x*m.x))) c FROM u t JOIN m USING (doc, d) WHERE t.vec_id%6=0 GROUP BY 1) SELECT e.vec_id//6 doc, coalesce(k.n,0) n_many, round(c,5) AS cosine FROM embeddings e LEFT JOIN j ON j.doc=e.vec_id//6 LEFT JOIN k ON k.doc=e.vec_id//6 WHERE e.vec_id%6=0"""),
    "l13_validators": (l13_validators, """SELECT 'l_quantity' feature, 'error' severity, count(*) n, round(max(l_quantity),4) worst FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 45 UNION ALL SELECT 'l_discount','warning',count(*),round(max(l_discount),4) FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.08::DOUBLE
      UNION ALL SELECT 'price_of_quantity','info',count(*),NULL FROM lineitem WHERE l_extendedprice>1000*l_quantity UNION ALL SELECT 'tax_without_discount','warning',count(*),NULL FROM lineitem WHERE l_discount=0 AND l_tax>0.07::DOUBLE"""),
    "l14_emotion_summary": (l14_emotion_summary, _EMO),
}
