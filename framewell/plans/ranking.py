"""Queries of rank statistics, splits, top-k, sampling and planners."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import values as V
from framewell.operators import ranks as R
from framewell.plans.common import table


def _items(spark, sf):
    return table(spark, sf, "lineitem")


def a21_mae(spark, sf):
    return _items(spark, sf).groupBy("l_returnflag").agg(F.round(R.mae("l_quantity", "l_linenumber"), 6).alias("mae"))


def a22_spearman(spark, sf):
    return R.spearman(_items(spark, sf), [], "l_quantity", "l_extendedprice").select("n", F.round("spearman", 6).alias("spearman"))


def a23_metrics_by_bucket(spark, sf):
    rows = table(spark, sf, "orders").select(F.when(F.col("o_totalprice") < 100000, "small").when(F.col("o_totalprice") < 200000, "mid").otherwise("large").alias("bucket"), "o_totalprice", "o_custkey")
    return R.spearman(rows, ["bucket"], "o_totalprice", "o_custkey").join(rows.groupBy("bucket").agg(F.round(R.mae("o_totalprice", "o_custkey"), 3).alias("mae")), "bucket").select("bucket", "n", F.round("spearman", 6).alias("spearman"), "mae")


def a24_coverage(spark, sf):
    q = F.col("l_quantity")
    return _items(spark, sf).agg(F.round(F.avg(q.between(F.col("l_linenumber") * 5, F.col("l_linenumber") * 10).cast("int")), 8).alias("coverage"), F.round(F.avg((F.col("l_linenumber") * 5 <= F.col("l_linenumber") * 10).cast("int")), 8).alias("monotonic"))


def a26_redundant_pairs(spark, sf):
    return R.redundant_pairs(_items(spark, sf).withColumn("neg", -F.col("l_quantity")), "l_orderkey", ["l_quantity", "l_extendedprice", "l_discount", "neg"], 0.5).select("feature_a", "feature_b", F.round("spearman", 6).alias("spearman"))


def a27_feature_signal(spark, sf):
    rows = _items(spark, sf).select("l_extendedprice", F.expr("stack(3, 'l_quantity', l_quantity, 'l_discount', l_discount, 'l_tax', l_tax) AS (feature, value)"))
    return R.spearman(rows, ["feature"], "value", "l_extendedprice", 30).select("feature", "n", F.round("spearman", 6).alias("spearman"))


def a28_correlations(spark, sf):
    return R.correlation_pairs(_items(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 3).select("feature_a", "feature_b", F.round("corr", 6).alias("corr"))


def w01_average_rank(spark, sf):
    return R.average_rank(_items(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), ["l_returnflag"], "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity", "rank")


def l04_residual_signal(spark, sf):
    rows = _items(spark, sf)
    fit = rows.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("a"), F.regr_intercept("l_extendedprice", "l_quantity").alias("b")).first()
    res = rows.withColumn("residual", F.round(F.col("l_extendedprice") - fit["a"] * F.col("l_quantity") - fit["b"], 4))
    return R.spearman(res, ["l_returnflag"], "residual", "l_discount").select("l_returnflag", "n", F.round("spearman", 5).alias("spearman"))


def p04_numeric_features(spark, sf):
    names = R.numeric_features(_items(spark, sf).withColumn("flat", F.lit(1.0)), ["l_orderkey"])
    return spark.createDataFrame([(n,) for n in names], "feature string")


def p05_finite_rate(spark, sf):
    e = table(spark, sf, "events")
    raw = e.select(F.get_json_object("props", "$.k").alias("a"), F.col("value").cast("string").alias("b"), F.col("event_type").alias("c")).unpivot([], ["a", "b", "c"], "column", "raw")
    return raw.groupBy("column").agg(F.round(F.avg(V.lenient_finite("raw").isNotNull().cast("int")), 6).alias("rate")).where("rate >= 0.7")


def p19_median_fill(spark, sf):
    rows = _items(spark, sf).select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")).alias("q"))
    return R.median_fill(rows, ["q"])


def o01_comment_order(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL AND value IS NOT NULL")
    return R.top_k(e.select("user_id", "event_id", F.floor("value").alias("likes"), F.floor(F.col("event_id") / 50).alias("recency")), ["user_id"], [F.desc("likes"), F.desc("recency"), F.asc("event_id")], 4)


def o02_top_k(spark, sf):
    return R.top_k(_items(spark, sf).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"), ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 3)


def o03_comment_score(spark, sf):
    t = table(spark, sf, "conversations")
    score = F.col("turn") + 0.5 * (F.col("conv_id") % 7) + 0.1 * F.least(F.length(F.coalesce("text", F.lit(""))), F.lit(200)) / 200
    return t.select("conv_id", "turn", F.round(score, 6).alias("score"))


def o04_shortlist(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") * 37 % 101).alias("health"), (F.col("p_partkey") * 13 % 17).alias("nan"))
    reason = F.concat_ws(";", F.when(F.col("health") < 40, "health"), F.when(F.col("nan") > 8, "nan"))
    return p.withColumn("reason", reason).where("reason <> ''").orderBy("health", F.desc("nan"), "p_partkey").limit(50)


def o05_golden_sets(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey").withColumn("h", R.hash_order("o_orderkey"))
    top = o.orderBy("h").limit(150)
    ranked = R.top_k(top.withColumn("g", F.lit(1)), ["g"], [F.col("h")], 150)
    return ranked.select("o_orderkey", F.when(F.col("rank") <= 100, "holdout").otherwise("regression").alias("part"))


def o06_hash_sample(spark, sf):
    return table(spark, sf, "customer").select("c_custkey").orderBy(R.hash_order("c_custkey", "7"), "c_custkey").limit(40)


def o07_extremes(spark, sf):
    p = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    top = R.top_k(p, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2).withColumn("side", F.lit("most"))
    low = R.top_k(p, ["o_custkey"], [F.asc("o_totalprice"), F.asc("o_orderkey")], 2).withColumn("side", F.lit("least"))
    return top.unionByName(low).select("o_custkey", "o_orderkey", "rank", "side")


def _slots(items):
    top = R.top_k(items.select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], [F.desc("l_extendedprice"), F.asc("l_linenumber")], 4)
    slots = top.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("rank", "l_extendedprice"))).alias("m"))
    return slots.select("l_orderkey", *(F.try_element_at("m", F.lit(i)).alias(f"top{i}") for i in range(1, 5)))


def o08_slots(spark, sf):
    return _slots(_items(spark, sf))


def o08_slots_all(spark, sf):
    return _slots(_items(spark, sf))


def o09_limit(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


def o10_time_split(spark, sf):
    return R.time_split(table(spark, sf, "orders"), "o_orderdate", "o_orderkey", 0.7, 0.15).select("o_orderkey", "split")


def o11_group_time_split(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return R.group_time_split(o, "o_custkey", "o_orderdate", 0.7, 0.15).select("o_orderkey", "split")


def o12_grouped_folds(spark, sf):
    return R.grouped_folds(table(spark, sf, "orders"), "o_custkey", 5).groupBy("o_custkey").agg(F.max("fold").alias("fold"), F.count("*").alias("n"))


def o13_allocate(spark, sf):
    w = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("w"))
    return R.allocate(w, "o_orderpriority", "w", 1003)


def l09_batch_size(spark, sf):
    return table(spark, sf, "part").select("p_partkey", R.batch_size(F.col("p_partkey") * 3.0, F.lit(500.0), F.col("p_partkey") % 40, 64).alias("batch"))


def l10_active_cost(spark, sf):
    rows = _items(spark, sf).select("l_suppkey", F.col("l_returnflag").alias("branch"), F.col("l_shipdate").alias("valid_from"), "l_orderkey", "l_linenumber", F.expr("CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate + INTERVAL 400 DAYS END").alias("valid_to"))
    rows = rows.groupBy("l_suppkey", "branch", "valid_from").agg(F.max("valid_to").alias("valid_to"))
    return R.active_cost(rows, ["l_suppkey"], "valid_from", "valid_to", F.expr("timestamp'1996-01-01'"), "branch", "N").select("l_suppkey", "branch", F.col("valid_from").cast("string").alias("valid_from"))


_AR = "rank() OVER (PARTITION BY {k} ORDER BY {v}) + (count(*) OVER (PARTITION BY {k}, {v}) - 1) / 2.0"


def _spear(rows: str, key: str, x: str, y: str, least: int = 2, digits: int = 6) -> str:
    k = key or "1"
    lead = f"{key}, " if key else ""
    return f"WITH b AS ({rows}), r AS (SELECT {lead}{_AR.format(k=k, v=x)} rx, {_AR.format(k=k, v=y)} ry FROM b) SELECT {lead}count(*) n, CASE WHEN count(*)>={least} THEN round(corr(rx,ry),{digits}) END spearman FROM r" + (f" GROUP BY {key}" if key else "")


QUERIES = {
    "a21_mae": (a21_mae, "SELECT l_returnflag, round(avg(abs(l_quantity-l_linenumber)),6) mae FROM lineitem GROUP BY 1"),
    "a22_spearman": (a22_spearman, _spear("SELECT l_quantity, l_extendedprice FROM lineitem", "", "l_quantity", "l_extendedprice")),
    "a23_metrics_by_bucket": (a23_metrics_by_bucket, f"WITH b AS (SELECT CASE WHEN o_totalprice<100000 THEN 'small' WHEN o_totalprice<200000 THEN 'mid' ELSE 'large' END bucket, o_totalprice, o_custkey FROM orders), r AS (SELECT *, {_AR.format(k='bucket', v='o_totalprice')} rx, {_AR.format(k='bucket', v='o_custkey')} ry FROM b) SELECT bucket, count(*) n, round(corr(rx,ry),6) spearman, round(avg(abs(o_totalprice-o_custkey)),3) mae FROM r GROUP BY 1"),
    "a24_coverage": (a24_coverage, "SELECT round(avg((l_quantity BETWEEN l_linenumber*5 AND l_linenumber*10)::INT),8) coverage, 1.0::DOUBLE monotonic FROM lineitem"),
    "a26_redundant_pairs": (a26_redundant_pairs, "WITH r AS (SELECT " + ", ".join(f"{_AR.format(k='1', v=v)} r{i}" for i, v in enumerate(("l_quantity", "l_extendedprice", "l_discount", "(-l_quantity)"))) + " FROM lineitem), c AS (" + " UNION ALL ".join(f"SELECT '{a}' feature_a, '{b}' feature_b, round(corr(r{i},r{j}),6) spearman FROM r" for i, a in enumerate(("l_quantity", "l_extendedprice", "l_discount", "neg")) for j, b in enumerate(("l_quantity", "l_extendedprice", "l_discount", "neg")) if i < j) + ") SELECT * FROM c WHERE abs(spearman)>=0.5"),
    "a27_feature_signal": (a27_feature_signal, _spear("SELECT unnest(['l_quantity','l_discount','l_tax']) feature, unnest([l_quantity,l_discount,l_tax]) v, l_extendedprice FROM lineitem", "feature", "v", "l_extendedprice", 30)),
    "a28_correlations": (a28_correlations, "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' feature_a, '{b}' feature_b, round(corr({a},{b}),6) corr FROM lineitem" for i, a in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax")) for j, b in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax")) if i < j) + ") ORDER BY abs(corr) DESC, 1, 2 LIMIT 3"),
    "w01_average_rank": (w01_average_rank, f"SELECT l_orderkey, l_linenumber, l_quantity, ({_AR.format(k='l_returnflag', v='l_quantity')})::DOUBLE \"rank\" FROM lineitem"),
    "l04_residual_signal": (l04_residual_signal, f"WITH f AS (SELECT regr_slope(l_extendedprice,l_quantity) a, regr_intercept(l_extendedprice,l_quantity) b FROM lineitem), x AS (SELECT l_returnflag, l_discount, round(l_extendedprice-a*l_quantity-b,4) e FROM lineitem, f), r AS (SELECT l_returnflag, {_AR.format(k='l_returnflag', v='e')} rx, {_AR.format(k='l_returnflag', v='l_discount')} ry FROM x) SELECT l_returnflag, count(*) n, round(corr(rx,ry),5) spearman FROM r GROUP BY 1"),
    "p04_numeric_features": (p04_numeric_features, "SELECT unnest(['l_partkey','l_suppkey','l_linenumber','l_quantity','l_extendedprice','l_discount','l_tax']) feature"),
    "p05_finite_rate": (p05_finite_rate, "WITH r AS (SELECT unnest(['a','b','c']) AS column, unnest([json_extract_string(props,'$.k'), value::VARCHAR, event_type]) raw FROM events) SELECT \"column\", round(avg((try_cast(raw AS DOUBLE) IS NOT NULL AND isfinite(try_cast(raw AS DOUBLE)))::INT),6) rate FROM r GROUP BY 1 HAVING rate>=0.7"),
    "p19_median_fill": (p19_median_fill, "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey%5<>0 THEN l_quantity ELSE (SELECT median(l_quantity) FROM lineitem WHERE l_orderkey%5<>0) END q FROM lineitem"),
    "o01_comment_order": (o01_comment_order, "SELECT user_id, event_id, floor(value)::BIGINT likes, (event_id//50)::BIGINT recency, row_number() OVER (PARTITION BY user_id ORDER BY floor(value) DESC, event_id//50 DESC, event_id)::INT \"rank\" FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL QUALIFY \"rank\"<=4"),
    "o02_top_k": (o02_top_k, "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)::INT \"rank\" FROM lineitem QUALIFY \"rank\"<=3"),
    "o03_comment_score": (o03_comment_score, "SELECT conv_id, turn, round((turn+0.5*(conv_id%7)+0.1*least(length(coalesce(text,'')),200)/200)::DOUBLE,6) score FROM conversations"),
    "o04_shortlist": (o04_shortlist, "WITH p AS (SELECT p_partkey, p_partkey*37%101 health, p_partkey*13%17 AS nan FROM part) SELECT *, concat_ws(';', CASE WHEN health<40 THEN 'health' END, CASE WHEN nan>8 THEN 'nan' END) reason FROM p WHERE health<40 OR nan>8 ORDER BY health, nan DESC, p_partkey LIMIT 50"),
    "o05_golden_sets": (o05_golden_sets, "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY sha256('1337::'||o_orderkey)) i FROM orders) SELECT o_orderkey, CASE WHEN i<=100 THEN 'holdout' ELSE 'regression' END part FROM r WHERE i<=150"),
    "o06_hash_sample": (o06_hash_sample, "SELECT c_custkey FROM customer ORDER BY sha256('7::'||c_custkey) LIMIT 40"),
    "o07_extremes": (o07_extremes, "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT \"rank\", 'most' side FROM orders QUALIFY \"rank\"<=2 UNION ALL SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey)::INT \"rank\", 'least' FROM orders QUALIFY \"rank\"<=2"),
    "o08_slots": (o08_slots, "WITH r AS (SELECT l_orderkey, l_extendedprice v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) i FROM lineitem) SELECT l_orderkey, max(v) FILTER (i=1) top1, max(v) FILTER (i=2) top2, max(v) FILTER (i=3) top3, max(v) FILTER (i=4) top4 FROM r GROUP BY 1"),
    "o08_slots_all": (o08_slots_all, "WITH r AS (SELECT l_orderkey, l_extendedprice v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) i FROM lineitem) SELECT l_orderkey, max(v) FILTER (i=1) top1, max(v) FILTER (i=2) top2, max(v) FILTER (i=3) top3, max(v) FILTER (i=4) top4 FROM r GROUP BY 1"),
    "o09_limit": (o09_limit, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"),
    "o10_time_split": (o10_time_split, "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) i, count(*) OVER () n FROM orders WHERE o_orderdate IS NOT NULL) SELECT o_orderkey, CASE WHEN i<=round_even(n*0.7,0) THEN 'train' WHEN i<=round_even(n*0.7,0)+round_even(n*0.15,0) THEN 'valid' ELSE 'test' END split FROM r"),
    "o11_group_time_split": (o11_group_time_split, "WITH g AS (SELECT o_custkey, min(coalesce(o_orderdate, TIMESTAMP '1970-01-01')) t FROM orders GROUP BY 1), r AS (SELECT o_custkey, row_number() OVER (ORDER BY t, o_custkey) i, count(*) OVER () n FROM g) SELECT o_orderkey, CASE WHEN i<=floor(n*0.7) THEN 'train' WHEN i<=floor(n*(0.7+0.15)) THEN 'valid' ELSE 'test' END split FROM orders JOIN r USING (o_custkey)"),
    "o12_grouped_folds": (o12_grouped_folds, "WITH RECURSIVE g AS (SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS i FROM orders GROUP BY 1), r AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS o_custkey, NULL::BIGINT AS n, NULL::INT AS fold, [0,0,0,0,0]::BIGINT[] AS load UNION ALL SELECT g.i, g.o_custkey, g.n, list_position(load, list_min(load))-1, list_transform(load, lambda x, j: x + CASE WHEN j = list_position(load, list_min(load)) THEN g.n ELSE 0 END) FROM r JOIN g ON g.i = r.i + 1) SELECT o_custkey, fold, n FROM r WHERE i > 0"),
    "o13_allocate": (o13_allocate, "WITH w AS (SELECT o_orderpriority, count(*) w FROM orders GROUP BY 1), f AS (SELECT *, floor(1003*w/sum(w) OVER ()) f FROM w), r AS (SELECT *, 1003-sum(f) OVER () l, row_number() OVER (ORDER BY w DESC, o_orderpriority) i FROM f) SELECT o_orderpriority, (f+(i<=l)::INT)::BIGINT AS count FROM r"),
    "l09_batch_size": (l09_batch_size, "SELECT p_partkey, CASE WHEN p_partkey%40=0 THEN 64 ELSE greatest(1, least(64, floor((p_partkey*3.0-500)/(p_partkey%40)))) END::BIGINT batch FROM part"),
    "l10_active_cost": (l10_active_cost, "WITH r AS (SELECT l_suppkey, l_returnflag branch, l_shipdate valid_from, max(CASE WHEN l_linenumber%2=0 THEN l_shipdate+to_days(400) END) valid_to FROM lineitem GROUP BY ALL) SELECT l_suppkey, branch, strftime(valid_from,'%Y-%m-%d %H:%M:%S') valid_from FROM r WHERE valid_from<=TIMESTAMP '1996-01-01' AND (valid_to IS NULL OR valid_to>TIMESTAMP '1996-01-01') QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY (branch<>'N')::INT, branch, r.valid_from DESC)=1"),
}
