"""Queries of the vector operators over embeddings: label = category or track."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.operators import vectors as V
from framewell.operators.ranks import top_k
from framewell.plans.common import table


def _e(spark, sf):
    return table(spark, sf, "embeddings").where("embedding IS NOT NULL")


def _at(vector, *places):
    return [F.round(F.col(vector)[i], 5).alias(f"x{i}") for i in places]


def v01_normalise(spark, sf):
    return _e(spark, sf).select("vec_id", F.round(V.norm(V.normalise("embedding")), 6).alias("unit"), F.round(V.normalise("embedding", "add")[0], 5).alias("x0"))


def v02_cosine(spark, sf):
    e = _e(spark, sf)
    a, b = e.select("label", "vec_id", "embedding"), e.select(F.col("vec_id").alias("other"), F.col("embedding").alias("v"))
    return a.join(b, F.col("other") == F.col("vec_id") + 1).select("vec_id", F.round(V.cosine("embedding", "v"), 6).alias("cosine"), V.cosine_flag("embedding", "v").alias("flag"))


def v04_one_to_many(spark, sf):
    e = _e(spark, sf)
    title = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("t"), F.min("vec_id").alias("first"))
    rows = e.join(title, "label").where("vec_id <> first").withColumn("c", V.cosine("embedding", "t")).where("c IS NOT NULL")
    return rows.groupBy("label").agg(F.count("*").alias("n"), *(F.round(x, 6).alias(n) for n, x in (("mean", F.avg("c")), ("median", F.median("c")), ("std", F.stddev_pop("c")), ("p95", F.percentile("c", F.lit(0.95))))))


def v08_topk_cosine(spark, sf):
    e = _e(spark, sf)
    return V.top_k_cosine(e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), e, "query_id", "vec_id", "embedding", 5).select("query_id", "rank", "vec_id", F.round("score", 5).alias("score"))


def v07_corpus_topk(spark, sf):
    e = _e(spark, sf)
    t = V.top_k_cosine(e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), e, "query_id", "vec_id", "embedding", 4, True)
    return t.groupBy("query_id").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.max("rank").alias("n"))


def _centroids(spark, sf):
    return V.mean_vector(_e(spark, sf), ["label"], "embedding")


def v09_nearest_centroid(spark, sf):
    t = V.top_k_cosine(_e(spark, sf), _centroids(spark, sf).withColumnRenamed("vector", "embedding"), "vec_id", "label", "embedding", 2)
    return t.groupBy("vec_id").agg(F.min_by("label", "rank").alias("cluster"), F.round(1 - F.max("score"), 5).alias("distance"), F.round(F.max("score") - F.min("score"), 5).alias("margin"))


def v09_projected_centroid(spark, sf):
    """Nearest label centroid in the space of the first eight principal components of all vectors."""
    from framewell.operators import projection as P

    e = _e(spark, sf)
    found = P.nearest_projected(e, _centroids(spark, sf).withColumnRenamed("vector", "embedding"), "vec_id", "label", "embedding", P.fit_projection(e, "embedding", 8))
    return found.select("vec_id", "cluster", F.round("distance", 5).alias("distance"), F.round("margin", 5).alias("margin"))


def _cluster_entropy(spark, sf, rows):
    from pyspark.sql.window import Window

    from framewell.functions.values import softmax_over

    t = V.top_k_cosine(rows, _centroids(spark, sf).withColumnRenamed("vector", "embedding"), "vec_id", "label", "embedding", 5)
    p = t.withColumn("p", softmax_over(F.col("score"), Window.partitionBy("vec_id"), 0.1))
    return V.entropy(p, ["vec_id"], "p").select("vec_id", *(F.round(c, 5).alias(c) for c in ("entropy", "normalised", "perplexity")))


def v10_cluster_entropy(spark, sf):
    return _cluster_entropy(spark, sf, _e(spark, sf))


def v11_threshold_after_k(spark, sf):
    return v08_topk_cosine(spark, sf).where("score >= 0.4").select("query_id", "vec_id")


def v12_filtered_search(spark, sf):
    e = _e(spark, sf)
    return V.top_k_cosine(e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), e.where("label % 2 = 0"), "query_id", "vec_id", "embedding", 10).select("query_id", "rank", "vec_id")


def v13_primary(spark, sf):
    e = _e(spark, sf).select("vec_id", F.when(F.col("vec_id") % 3 == 0, F.col("embedding")).alias("a"), F.when(F.col("vec_id") % 2 == 0, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")).alias("b"), F.col("embedding").alias("c"))
    v = V.first_vector("a", "b", "c")
    return e.select("vec_id", F.round(v[0], 5).alias("x0"), F.when(F.col("a").isNotNull(), "a").when(F.col("vec_id") % 2 == 1, "b").otherwise("c").alias("source"))


def v14_upsert(spark, sf):
    e = _e(spark, sf).select("vec_id", "label")
    changed = e.where("vec_id % 7 = 0").withColumn("label", F.col("label") + 100).union(e.where("vec_id % 50 = 0").select(F.col("vec_id") + 1_000_000, "label"))
    return V.upsert(e, changed, e.where("vec_id % 14 = 0").select("vec_id"), "vec_id")


def f27_vector_id(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", V.vector_id("embedding").alias("source_id"))


def a29_mean_vector(spark, sf):
    m = V.mean_vector(_e(spark, sf), ["label"], "embedding", F.col("vec_id") % 5 + 1.0)
    return m.join(V.spread(_e(spark, sf), ["label"], "embedding"), "label").select("label", *_at("vector", 0, 3, 7), F.round("mean_std", 6).alias("mean_std"), F.round("element_std", 6).alias("element_std"))


def a30_median_vector(spark, sf):
    return V.median_vector(_e(spark, sf), ["label"], "embedding").select("label", *_at("vector", 0, 5))


def a31_decay_and_max(spark, sf):
    from pyspark.sql.window import Window

    e = _e(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1)
    m = V.mean_vector(e, ["label"], "embedding", F.exp(-0.1 * F.col("i")) * (F.col("vec_id") % 3 + 1), False)
    return m.select("label", *_at("vector", 0, 2)).join(V.max_vector(e, ["label"], "embedding").select("label", F.round(F.col("vector")[1], 5).alias("max1")), "label")


def a32_logsumexp(spark, sf):
    return V.logsumexp_vector(_e(spark, sf), ["label"], "embedding").select("label", *_at("vector", 0, 1))


def a33_trimmed(spark, sf):
    return V.trimmed_mean(_e(spark, sf), ["label"], "embedding").select("label", *_at("vector", 0, 1))


def a35_chunk_variance(spark, sf):
    return V.chunk_variance(_e(spark, sf), ["label"], "embedding").select("label", F.round("variance_norm", 6).alias("variance_norm"), F.round(F.col("top")[0], 6).alias("top0"))


def a36_entropy(spark, sf):
    c = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("w"))
    return V.entropy(c, ["o_custkey"], "w").select("o_custkey", *(F.round(x, 6).alias(x) for x in ("entropy", "normalised", "perplexity")))


def _topics(e, prompts):
    t = V.best_by_group(e, prompts, "vec_id", "prompt", "embedding", "topic", True)
    return top_k(t, ["vec_id"], [F.desc(F.round("score", 9)), F.col("topic")], 3).select("vec_id", "topic", "rank", F.round("score", 5).alias("score"))


def _prompts(e):
    return e.withColumnRenamed("vec_id", "prompt").withColumnRenamed("label", "topic")


def a37_topics(spark, sf):
    e = _e(spark, sf)
    return _topics(e, _prompts(e))


def a37_topics_all(spark, sf):
    """All rows against all rows but themselves as prompts."""
    return _topics(_e(spark, sf), _prompts(_e(spark, sf)))


def a37_topic_distribution(spark, sf):
    """Two prompts a label, its mean and its mean of even ids, as topics: the three best, their softmax, and its entropy."""
    e = _e(spark, sf)
    prompts = V.mean_vector(e, ["label"], "embedding").unionByName(V.mean_vector(e.where("vec_id % 2 = 0"), ["label"], "embedding"))
    prompts = prompts.select(F.col("label").alias("topic"), F.col("vector").alias("embedding"), F.xxhash64("label", "vector").alias("prompt"))
    best = V.topic_distribution(V.best_by_group(e, prompts, "vec_id", "prompt", "embedding", "topic"), "vec_id", "topic", "score", 3, 0.1)
    return best.select("vec_id", "rank", "topic", F.round("probability", 5).alias("probability"), F.round("entropy", 5).alias("entropy"))


def a38_track_topk(spark, sf):
    e, g = _e(spark, sf).withColumnRenamed("label", "track"), _e(spark, sf).select(F.col("vec_id").alias("gid"), "embedding")
    t = V.top_k_cosine(e, g, "vec_id", "gid", "embedding", 3).join(e.select("vec_id", "track"), "vec_id").groupBy("track", "gid").agg(F.max("score").alias("score"))
    return top_k(t, ["track"], [F.desc(F.round("score", 9)), F.col("gid")], 3).select("track", "gid", "rank")


def _as_query(e):
    return e.withColumnRenamed("vec_id", "query_id")


def v08_topk_cosine_all(spark, sf):
    e = _e(spark, sf)
    return V.top_k_cosine_all(_as_query(e), e, "query_id", "vec_id", "embedding", 5).select("query_id", "rank", "vec_id", F.round("score", 5).alias("score"))


def v07_corpus_topk_all(spark, sf):
    e = _e(spark, sf)
    t = V.top_k_cosine_all(_as_query(e), e, "query_id", "vec_id", "embedding", 4, True)
    return t.groupBy("query_id").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.max("rank").alias("n"))


def v10_cluster_entropy_all(spark, sf):
    return _cluster_entropy(spark, sf, _e(spark, sf))


def v11_threshold_after_k_all(spark, sf):
    return v08_topk_cosine_all(spark, sf).where("score >= 0.4").select("query_id", "vec_id")


def v12_filtered_search_all(spark, sf):
    e = _e(spark, sf)
    return V.top_k_cosine_all(_as_query(e), e.where("label % 2 = 0"), "query_id", "vec_id", "embedding", 10).select("query_id", "rank", "vec_id")


def a38_track_topk_all(spark, sf):
    """All rows of a track against all rows but themselves; a row's best three hold all that can be among the track's."""
    e = _e(spark, sf).withColumnRenamed("label", "track")
    t = V.top_k_cosine_all(e, e.withColumnRenamed("vec_id", "gid"), "vec_id", "gid", "embedding", 3, True).join(e.select("vec_id", "track"), "vec_id").groupBy("track", "gid").agg(F.max("score").alias("score"))
    return top_k(t, ["track"], [F.desc(F.round("score", 9)), F.col("gid")], 3).select("track", "gid", "rank")


def a44_uniqueness(spark, sf):
    e = _e(spark, sf).withColumn("video", F.expr("vec_id div 25"))
    return V.uniqueness(e, ["video"], "vec_id", "embedding", 0.5).select("video", "n", *(F.round(c, 5).alias(c) for c in ("repetition_ratio", "p95_similarity", "diversity")))


def w02_consecutive(spark, sf):
    return V.consecutive_similarity(_e(spark, sf), ["label"], "vec_id", "embedding").select("vec_id", F.round("similarity", 5).alias("similarity"), F.round("novelty", 5).alias("novelty"))


def w24_shift(spark, sf):
    return V.start_end_shift(_e(spark, sf), ["label"], "vec_id", "embedding").select("label", F.round("shift_cosine", 5).alias("shift_cosine"))


_D = "d AS (SELECT vec_id, label, generate_subscripts(embedding,1)-1 d, unnest(embedding)::DOUBLE x FROM embeddings WHERE embedding IS NOT NULL)"
_COS = "list_dot_product({a}::DOUBLE[],{b}::DOUBLE[])/sqrt(list_dot_product({a}::DOUBLE[],{a}::DOUBLE[])*list_dot_product({b}::DOUBLE[],{b}::DOUBLE[]))"
_CENT = _D + ", md AS (SELECT label, d, avg(x) m FROM d GROUP BY ALL), cent AS (SELECT label, list(m ORDER BY d) v FROM md GROUP BY 1)"
_ab = _COS.format(a="a.embedding", b="b.embedding")
QUERIES = {
    "v01_normalise": (v01_normalise, "SELECT vec_id, CASE WHEN list_dot_product(embedding::DOUBLE[],embedding::DOUBLE[])>0 THEN 1.0 ELSE 0 END::DOUBLE unit, round(embedding[1]::DOUBLE/(sqrt(list_dot_product(embedding::DOUBLE[],embedding::DOUBLE[]))+1e-9),5) x0 FROM embeddings WHERE embedding IS NOT NULL"),
    "v02_cosine": (v02_cosine, f"SELECT a.vec_id, round({_ab},6) cosine, 'ok' flag FROM embeddings a JOIN embeddings b ON b.vec_id=a.vec_id+1"),
    "v04_one_to_many": (v04_one_to_many, f"WITH b AS (SELECT label, arg_min(embedding,vec_id) embedding, min(vec_id) f FROM embeddings GROUP BY 1), c AS (SELECT a.label, {_ab} c FROM embeddings a JOIN b ON a.label=b.label AND a.vec_id<>b.f) SELECT label, count(*) n, round(avg(c),6) mean, round(median(c),6) median, round(stddev_pop(c),6) std, round(quantile_cont(c,0.95),6) p95 FROM c GROUP BY 1"),
    "v08_topk_cosine": (v08_topk_cosine, f"WITH c AS (SELECT a.vec_id query_id, b.vec_id, {_ab} c FROM embeddings a, embeddings b WHERE a.vec_id%20=0) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(c,12) DESC, vec_id)::INT \"rank\", vec_id, round(c,5) score FROM c QUALIFY \"rank\"<=5"),
    "v07_corpus_topk": (v07_corpus_topk, f"WITH c AS (SELECT a.vec_id query_id, b.vec_id, {_ab} c FROM embeddings a, embeddings b WHERE a.vec_id%20=0 AND a.vec_id<>b.vec_id), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(c,12) DESC, vec_id)<=4) SELECT query_id, round(avg(c),6) mean_score, count(*)::INT n FROM t GROUP BY 1"),
    "v09_nearest_centroid": (v09_nearest_centroid, f"WITH {_CENT}, c AS (SELECT vec_id, cent.label, {_COS.format(a='embedding', b='v')} c FROM embeddings, cent), t AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(c,12) DESC, label) i FROM c QUALIFY i<=2) SELECT vec_id, arg_min(label,i) AS cluster, round(1-max(c),5) distance, round(max(c)-min(c),5) margin FROM t GROUP BY 1"),
    "v10_cluster_entropy": (v10_cluster_entropy, f"WITH {_CENT}, c AS (SELECT vec_id, cent.label, {_COS.format(a='embedding', b='v')} c FROM embeddings, cent), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(c,12) DESC, label)<=5), e AS (SELECT vec_id, exp((c-max(c) OVER (PARTITION BY vec_id))/0.1) e FROM t), p AS (SELECT vec_id, e/sum(e) OVER (PARTITION BY vec_id) p FROM e), h AS (SELECT vec_id, -sum(p*ln(p+1e-12)) h, count(*) k FROM p GROUP BY 1) SELECT vec_id, round(h,5) entropy, round(CASE WHEN k>1 THEN h/ln(k) ELSE 0 END,5) normalised, round(exp(h),5) perplexity FROM h"),
    "v11_threshold_after_k": (v11_threshold_after_k, f"WITH c AS (SELECT a.vec_id query_id, b.vec_id, {_ab} c FROM embeddings a, embeddings b WHERE a.vec_id%20=0), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(c,12) DESC, vec_id)<=5) SELECT query_id, vec_id FROM t WHERE round(c,5)>=0.4"),
    "v12_filtered_search": (v12_filtered_search, f"WITH c AS (SELECT a.vec_id query_id, b.vec_id, {_ab} c FROM embeddings a, embeddings b WHERE a.vec_id%20=0 AND b.label%2=0) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(c,12) DESC, vec_id)::INT \"rank\", vec_id FROM c QUALIFY \"rank\"<=10"),
    "v13_primary": (v13_primary, "SELECT vec_id, round(embedding[1]::DOUBLE,5) x0, CASE WHEN vec_id%3=0 THEN 'a' WHEN vec_id%2=1 THEN 'b' ELSE 'c' END AS source FROM embeddings"),
    "v14_upsert": (v14_upsert, "SELECT vec_id, label+CASE WHEN vec_id%7=0 THEN 100 ELSE 0 END AS label FROM embeddings WHERE vec_id%14<>0 UNION ALL SELECT vec_id+1000000, label FROM embeddings WHERE vec_id%50=0"),
    "a29_mean_vector": (a29_mean_vector, f"WITH {_D}, m AS (SELECT label, d, sum((vec_id%5+1)*x)/sum(vec_id%5+1) m, stddev_pop(x) s FROM d GROUP BY ALL), n AS (SELECT label, sqrt(sum(m*m)) n, avg(s) ms FROM m GROUP BY 1), s AS (SELECT label, stddev_samp(x) es FROM d GROUP BY 1) SELECT label, round(max(m/n) FILTER (d=0),5) x0, round(max(m/n) FILTER (d=3),5) x3, round(max(m/n) FILTER (d=7),5) x7, round(any_value(ms),6) mean_std, round(any_value(es),6) element_std FROM m JOIN n USING (label) JOIN s USING (label) GROUP BY 1"),
    "a30_median_vector": (a30_median_vector, f"WITH {_D} SELECT label, round(median(x) FILTER (d=0),5) x0, round(median(x) FILTER (d=5),5) x5 FROM d GROUP BY 1"),
    "a31_decay_and_max": (a31_decay_and_max, f"WITH {_D}, i AS (SELECT vec_id, exp(-0.1*(row_number() OVER (PARTITION BY label ORDER BY vec_id)-1))*(vec_id%3+1) w FROM embeddings) SELECT label, round(sum(w*x) FILTER (d=0)/sum(w) FILTER (d=0),5) x0, round(sum(w*x) FILTER (d=2)/sum(w) FILTER (d=2),5) x2, round(max(x) FILTER (d=1),5) max1 FROM d JOIN i USING (vec_id) GROUP BY 1"),
    "a32_logsumexp": (a32_logsumexp, f"WITH {_D}, m AS (SELECT label, d, max(x) m FROM d GROUP BY ALL), l AS (SELECT label, d, any_value(m)+ln(sum(exp(x-m))) l FROM d JOIN m USING (label,d) GROUP BY ALL) SELECT label, round(max(l) FILTER (d=0),5) x0, round(max(l) FILTER (d=1),5) x1 FROM l GROUP BY 1"),
    "a33_trimmed": (a33_trimmed, f"WITH {_D}, n AS (SELECT vec_id, label, sqrt(list_dot_product(embedding::DOUBLE[],embedding::DOUBLE[])) n FROM embeddings), q AS (SELECT label, quantile_cont(n,0.1) a, quantile_cont(n,0.9) b, count(*) k FROM n GROUP BY 1), t AS (SELECT vec_id FROM n JOIN q USING (label) WHERE k<4 OR n BETWEEN a AND b) SELECT label, round(avg(x) FILTER (d=0),5) x0, round(avg(x) FILTER (d=1),5) x1 FROM d WHERE vec_id IN (SELECT vec_id FROM t) GROUP BY 1"),
    "a35_chunk_variance": (a35_chunk_variance, f"WITH {_D}, v AS (SELECT label, d, var_pop(x) v FROM d GROUP BY ALL) SELECT label, round(sqrt(sum(v*v)),6) variance_norm, round(max(v),6) top0 FROM v GROUP BY 1"),
    "a36_entropy": (a36_entropy, "WITH c AS (SELECT o_custkey, o_orderstatus, count(*) w FROM orders GROUP BY ALL), p AS (SELECT o_custkey, w/sum(w) OVER (PARTITION BY o_custkey) p FROM c), h AS (SELECT o_custkey, -sum(p*ln(p+1e-12)) h, count(*) k FROM p GROUP BY 1) SELECT o_custkey, round(h,6) entropy, round(CASE WHEN k>1 THEN h/ln(k) ELSE 0 END,6) normalised, round(exp(h),6) perplexity FROM h"),
    "v09_projected_centroid": (v09_projected_centroid, None),
    "a37_topic_distribution": (a37_topic_distribution, f"WITH m AS (SELECT label, list(v ORDER BY i) v FROM (SELECT label, i, avg(x) v FROM (SELECT label, generate_subscripts(embedding,1) i, unnest(embedding)::DOUBLE x FROM embeddings) GROUP BY ALL) GROUP BY 1 UNION ALL SELECT label, list(v ORDER BY i) v FROM (SELECT label, i, avg(x) v FROM (SELECT label, generate_subscripts(embedding,1) i, unnest(embedding)::DOUBLE x FROM embeddings WHERE vec_id%2=0) GROUP BY ALL) GROUP BY 1), t AS (SELECT vec_id, m.label topic, max({_COS.format(a='embedding', b='v')}) s FROM embeddings, m GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s,9) DESC, topic)::INT r FROM t QUALIFY r<=3), p AS (SELECT *, exp((s-max(s) OVER w)/0.1)/sum(exp((s-max_s)/0.1)) OVER w p FROM (SELECT *, max(s) OVER (PARTITION BY vec_id) max_s FROM k) WINDOW w AS (PARTITION BY vec_id)) SELECT vec_id, r AS rank, topic, round(p,5) probability, round(-sum(p*ln(p+1e-9)) OVER (PARTITION BY vec_id),5) entropy FROM p"),
    "a37_topics": (a37_topics, f"WITH c AS (SELECT a.vec_id, b.label topic, max({_ab}) s FROM embeddings a, embeddings b WHERE a.vec_id<>b.vec_id GROUP BY ALL) SELECT vec_id, topic, row_number() OVER (PARTITION BY vec_id ORDER BY round(s,9) DESC, topic)::INT \"rank\", round(s,5) score FROM c QUALIFY \"rank\"<=3"),
    "a38_track_topk": (a38_track_topk, f"WITH c AS (SELECT a.vec_id, a.label track, b.vec_id gid, {_ab} s FROM embeddings a, embeddings b), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(s,12) DESC, gid)<=3), m AS (SELECT track, gid, max(s) s FROM t GROUP BY ALL) SELECT track, gid, row_number() OVER (PARTITION BY track ORDER BY round(s,9) DESC, gid)::INT \"rank\" FROM m QUALIFY \"rank\"<=3"),
    "a44_uniqueness": (a44_uniqueness, f"WITH c AS (SELECT a.vec_id//25 video, a.vec_id i, {_ab} s FROM embeddings a JOIN embeddings b ON a.vec_id//25=b.vec_id//25 AND a.vec_id<>b.vec_id), n AS (SELECT video, i, max(s) m, avg(s) a FROM c GROUP BY ALL) SELECT video, count(*) n, round(avg((m>=0.5)::INT),5) repetition_ratio, round(quantile_cont(m,0.95),5) p95_similarity, round(1-avg(a),5) diversity FROM n GROUP BY 1"),
    "w02_consecutive": (w02_consecutive, f"WITH b AS (SELECT vec_id, embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) p FROM embeddings), c AS (SELECT vec_id, {_COS.format(a='embedding', b='p')} s FROM b) SELECT vec_id, round(s,5) similarity, round(1-s,5) novelty FROM c"),
    "w24_shift": (w24_shift, f"WITH {_D}, r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) i, count(*) OVER (PARTITION BY label) n FROM embeddings), k AS (SELECT *, least(3,greatest(1,n//2)) k FROM r), m AS (SELECT label, d, avg(x) FILTER (i<=k) a, avg(x) FILTER (i>n-k) b FROM d JOIN k USING (vec_id,label) GROUP BY ALL) SELECT label, round(sum(a*b)/sqrt(sum(a*a)*sum(b*b)),5) shift_cosine FROM m GROUP BY 1"),
    "f27_vector_id": (f27_vector_id, None),
    # Over all rows; the SQL above is of a part of them. tests/test_whole.py holds these against numpy.
    "v07_corpus_topk_all": (v07_corpus_topk_all, None),
    "v08_topk_cosine_all": (v08_topk_cosine_all, None),
    "v10_cluster_entropy_all": (v10_cluster_entropy_all, None),
    "v11_threshold_after_k_all": (v11_threshold_after_k_all, None),
    "v12_filtered_search_all": (v12_filtered_search_all, None),
    "a37_topics_all": (a37_topics_all, None),
    "a38_track_topk_all": (a38_track_topk_all, None),
}
