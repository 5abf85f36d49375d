"""Queries over lineitem and others: profiling, quality, drift and report aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import values as V
from framewell.operators import profile as P
from framewell.plans.common import table

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_UNPIVOT = "SELECT {keys} unnest(['l_quantity','l_extendedprice','l_discount','l_tax']) AS feature, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem"


def _long(spark, sf, *keys):
    return P.to_long(table(spark, sf, "lineitem"), list(keys), FEATURES)


def a01_array_summary(spark, sf):
    out = P.array_summary(_long(spark, sf, "l_returnflag"), ["l_returnflag", "feature"])
    return out.select("l_returnflag", "feature", "n", "is_empty", "all_non_finite", *(F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max", "p10", "p50", "p90")))


def a04_feature_quality(spark, sf):
    ranges = spark.createDataFrame([("l_quantity", 1.0, 45.0), ("l_discount", 0.0, 0.08)], "feature string, lo double, hi double")
    out = P.feature_quality(_long(spark, sf), ["feature"], ranges)
    return out.select("feature", "n_rows", "n_present", "n_finite", "n_distinct", "is_constant", "severity", *(F.round(c, 4).alias(c) for c in ("mean", "std", "p01", "p50", "p99", "coverage", "nan_rate", "oor_rate", "health")))


def a05_health(spark, sf):
    part = table(spark, sf, "part")
    frame = part.select("p_partkey", (F.col("p_partkey") % 7 / 10.0).alias("nan_rate"), (F.col("p_partkey") % 11 / 10.0).alias("oor_rate"), (F.col("p_partkey") % 10 / 10.0).alias("coverage"), (F.col("p_partkey") % 5 == 0).alias("constant"))
    h = P.health(F.col("nan_rate"), F.col("oor_rate"), F.col("coverage"), F.col("constant"))
    return frame.select("p_partkey", F.round(h, 6).alias("health"), P.severity(h).alias("severity"))


def a06_drift(spark, sf):
    rows = _long(spark, sf, "l_shipdate")
    a, b = rows.where("l_shipdate < timestamp'1995-06-17'"), rows.where("l_shipdate >= timestamp'1995-06-17'")
    out = P.drift(a, b, ["feature"])
    return out.select("feature", "severity", *(F.round(c, 5).alias(c) for c in ("coverage_a", "coverage_b", "mean_a", "mean_b", "p50_a", "p50_b", "ks", "score", "mean_diff", "p50_diff")))


def a07_ks_two_sample(spark, sf):
    rows = _long(spark, sf, "l_shipdate", "l_returnflag")
    a, b = rows.where("l_shipdate < timestamp'1995-06-17'"), rows.where("l_shipdate >= timestamp'1995-06-17'")
    return P.ks_two_sample(a, b, ["l_returnflag", "feature"]).select("l_returnflag", "feature", F.round("ks", 6).alias("ks"), "n_a", "n_b")


def a08_first_non_empty(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.col("event_type")).alias("event_type"), F.when(F.col("event_id") % 2 == 0, F.col("value").cast("int").cast("string")).alias("value"))
    return P.first_non_empty(rows, ["user_id"], "event_id", ["event_type", "value"])


def a09_group_collapse(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("platform"), F.col("o_orderstatus").alias("video"), "o_orderkey", "o_orderpriority")
    return P.first_non_empty(rows, ["platform", "video"], "o_orderkey", ["o_orderpriority"])


def a10_best_run(spark, sf):
    rows = table(spark, sf, "lineitem")
    return P.best_run(rows, "l_suppkey", "l_returnflag", F.col("l_linestatus") == "O")


def a11_distribution_summary(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", F.col("o_totalprice").alias("v"))
    ranks = P.nearest_rank_table(rows, ["o_orderpriority"], "v", [50, 90, 99]).groupBy("o_orderpriority").pivot("percent", [50.0, 90.0, 99.0]).agg(F.max("v")).toDF("o_orderpriority", "p50", "p90", "p99")
    sums = rows.groupBy("o_orderpriority").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.round(F.avg("v"), 2).alias("mean"))
    return sums.join(ranks, "o_orderpriority")


def a12_nearest_rank(spark, sf):
    return P.nearest_rank_table(table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").alias("v")), ["l_returnflag"], "v", [0, 25, 50, 75, 95, 100])


def a13_capacity(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("component"), F.when(F.col("l_linestatus") == "O", "cuda").otherwise("cpu").alias("device"), (F.col("l_extendedprice") * 10).cast("bigint").alias("ms"))
    run = rows.groupBy("run", "component").agg(F.sum("ms").alias("total"), F.sum(F.when(F.col("device") == "cpu", F.col("ms")).otherwise(0)).alias("cpu"), F.sum(F.when(F.col("device") == "cuda", F.col("ms")).otherwise(0)).alias("cuda"))
    ranks = P.nearest_rank_table(run, ["component"], "total", [50, 90, 95, 99]).groupBy("component").pivot("percent", [50.0, 90.0, 95.0, 99.0]).agg(F.max("total")).toDF("component", "p50", "p90", "p95", "p99")
    return run.groupBy("component").agg(F.count("*").alias("runs"), F.sum("cpu").alias("cpu_ms"), F.sum("cuda").alias("cuda_ms")).join(ranks, "component")


def a14_component_durations(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("component"), F.col("l_linestatus").alias("status"), F.col("l_quantity").cast("bigint").alias("ms"))
    return rows.groupBy("component").agg(F.count("*").alias("n"), F.min("ms").alias("lo"), F.max("ms").alias("hi"), F.expr("sum(ms) div count(ms)").alias("mean_floor"), F.count_if(F.col("status") == "O").alias("ok"), F.count_if(F.col("status") != "O").alias("other"))


def a15_fan_out(spark, sf):
    return P.fan_out_counts(table(spark, sf, "orders"), "o_orderstatus", ["o_orderpriority"])


def a16_channel_concentration(spark, sf):
    return P.concentration(table(spark, sf, "orders"), "o_custkey").select("n_channels", "top_count", F.round("top_share", 8).alias("top_share"), F.round("per_channel", 6).alias("per_channel"))


def a17_readiness(spark, sf):
    return P.readiness(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", [1, 2, 3])


def a18_poll_report(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("i"), "o_orderdate", "o_orderstatus")
    rows = rows.withColumn("due", F.col("o_orderdate") + F.expr("make_interval(0, 0, 0, 7 * i)")).withColumn("done", (F.col("o_orderstatus") == "F") & (F.col("i") == 1))
    now = F.expr("timestamp'1998-08-01'")
    return rows.groupBy("i").agg(F.count_if("done").alias("done"), F.count_if(~F.col("done") & (F.col("due") <= now)).alias("due_now"), F.count_if(~F.col("done") & (F.col("due") > now)).alias("pending"), F.min(F.when(~F.col("done") & (F.col("due") > now), F.col("due"))).cast("string").alias("next_due"))


def a19_inventory(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    out = None
    for name, cond in (("returned", "l_returnflag = 'R'"), ("accepted", "l_returnflag = 'A'"), ("none", "l_returnflag = 'N'"), ("open", "l_linestatus = 'O'"), ("final", "l_linestatus = 'F'")):
        left = orders.select(F.col("o_orderkey").alias("k")).distinct().join(items.where(cond).select(F.col("l_orderkey").alias("k")), "k", "left_anti").agg(F.lit(name).alias("queue"), F.count("*").alias("pending"))
        out = left if out is None else out.union(left)
    return out


def a20_period_stats(spark, sf):
    rows = table(spark, sf, "events").where("ts IS NOT NULL").select("event_type", F.when(F.col("event_id") % 4 == 0, "  ").when(F.col("event_id") % 4 == 1, F.col("event_type")).alias("code"), F.when(F.col("event_id") % 8 < 6, F.concat(F.lit("Err"), (F.col("event_id") % 3).cast("string"), F.lit(" at step"))).alias("error"))
    code = F.coalesce(F.nullif(F.trim("code"), F.lit("")), F.split("error", " ")[0], F.lit("unknown"))
    return rows.groupBy(code.alias("error_code")).agg(F.count("*").alias("n"), F.countDistinct("event_type").alias("kinds"))


def a25_feature_stats(spark, sf):
    rows = _long(spark, sf)
    v = V.finite("value")
    return rows.groupBy("feature").agg(F.round(F.avg(v.isNull().cast("double")), 6).alias("pct_nan"), F.countDistinct(v).alias("nunique"), (F.countDistinct(v) <= 1).alias("constant"), F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_samp(v), 4).alias("std"), F.min(v).alias("lo"), F.max(v).alias("hi"))


def p08_column_profile(spark, sf):
    c = table(spark, sf, "customer")
    cols = c.columns
    rows = c.select(*(F.col(x).cast("string").alias(x) for x in cols)).unpivot([], cols, "column", "raw")
    role = F.when(F.col("column").rlike("key$"), "id").when(F.col("column").rlike("_(1|2|3)$"), "leak").otherwise("feature")
    return rows.groupBy("column").agg(F.round(F.avg((~V.empty_like("raw")).cast("double")), 6).alias("nonempty_rate"), F.round(F.avg(V.lenient_finite("raw").isNotNull().cast("double")), 6).alias("numeric_rate")).withColumn("role", role)


_SIDES = f"WITH l AS ({_UNPIVOT.format(keys='l_shipdate, l_returnflag,')}), a AS (SELECT * FROM l WHERE l_shipdate < TIMESTAMP '1995-06-17'), b AS (SELECT * FROM l WHERE l_shipdate >= TIMESTAMP '1995-06-17')"
_KS = """, c AS (SELECT {k}, value v, sum(na) na, sum(nb) nb FROM (SELECT {k}, value, 1 na, 0 nb FROM a UNION ALL SELECT {k}, value, 0, 1 FROM b) GROUP BY ALL),
s AS (SELECT {k}, sum(na) OVER w ca, sum(nb) OVER w cb, sum(na) OVER (PARTITION BY {k}) ta, sum(nb) OVER (PARTITION BY {k}) tb FROM c WINDOW w AS (PARTITION BY {k} ORDER BY v)),
k AS (SELECT {k}, max(abs(ca / ta - cb / tb)) ks, max(ta)::BIGINT n_a, max(tb)::BIGINT n_b FROM s GROUP BY ALL)"""
_RANK = "WITH r AS (SELECT {k}, {v} v, row_number() OVER (PARTITION BY {k} ORDER BY {v}) - 1 i, count(*) OVER (PARTITION BY {k}) n FROM {t})"

QUERIES = {
    "a01_array_summary": (a01_array_summary, f"WITH l AS ({_UNPIVOT.format(keys='l_returnflag,')}) SELECT l_returnflag, feature, count(*) n, false is_empty, false all_non_finite, round(avg(value),4) mean, round(stddev_pop(value),4) std, round(min(value),4) min, round(max(value),4) max, round(quantile_cont(value,0.1),4) p10, round(quantile_cont(value,0.5),4) p50, round(quantile_cont(value,0.9),4) p90 FROM l GROUP BY ALL"),
    "a04_feature_quality": (a04_feature_quality, f"""WITH l AS ({_UNPIVOT.format(keys='')}), g AS (SELECT feature, count(*) n, count(DISTINCT value) d, avg(value) m, stddev_pop(value) s, quantile_cont(value,0.01) p01, quantile_cont(value,0.5) p50, quantile_cont(value,0.99) p99,
      avg(CASE WHEN feature='l_quantity' AND (value<1 OR value>45) OR feature='l_discount' AND (value<0 OR value>0.08) THEN 1.0 ELSE 0 END) oor FROM l GROUP BY feature), h AS (SELECT *, 100-30*oor-20*(CASE WHEN d<=1 THEN 1 ELSE 0 END) h FROM g)
      SELECT feature, n n_rows, n n_present, n n_finite, d n_distinct, d<=1 is_constant, CASE WHEN h<40 THEN 'high' WHEN h<70 THEN 'medium' ELSE 'low' END severity, round(m,4) mean, round(s,4) std, round(p01,4) p01, round(p50,4) p50, round(p99,4) p99, 1.0::DOUBLE coverage, 0.0::DOUBLE nan_rate, round(oor,4) oor_rate, round(h,4) health FROM h"""),
    "a05_health": (a05_health, "WITH x AS (SELECT p_partkey, least(100.0, greatest(0.0, 100 - 40*(p_partkey%7/10.0) - 30*(p_partkey%11/10.0) - 10*(1-p_partkey%10/10.0) - CASE WHEN p_partkey%5=0 THEN 20 ELSE 0 END)) h FROM part) SELECT p_partkey, round(h::DOUBLE,6) health, CASE WHEN round(h::DOUBLE,9)<40 THEN 'high' WHEN round(h::DOUBLE,9)<70 THEN 'medium' ELSE 'low' END severity FROM x"),
    "a06_drift": (a06_drift, _SIDES + _KS.format(k="feature") + """, x AS (SELECT feature, avg(value) m, quantile_cont(value,0.5) p FROM a GROUP BY 1), y AS (SELECT feature, avg(value) m, quantile_cont(value,0.5) p FROM b GROUP BY 1)
      SELECT feature, CASE WHEN 60*ks>=55 THEN 'high' WHEN 60*ks>=30 THEN 'medium' ELSE 'low' END severity, 1.0::DOUBLE coverage_a, 1.0::DOUBLE coverage_b, round(x.m,5) mean_a, round(y.m,5) mean_b, round(x.p,5) p50_a, round(y.p,5) p50_b, round(ks,5) ks, round(60*ks,5) score, round(y.m-x.m,5) mean_diff, round(y.p-x.p,5) p50_diff FROM k JOIN x USING (feature) JOIN y USING (feature)"""),
    "a07_ks_two_sample": (a07_ks_two_sample, _SIDES + _KS.format(k="l_returnflag, feature") + " SELECT l_returnflag, feature, CASE WHEN n_a>=2 AND n_b>=2 THEN round(ks,6) END ks, n_a, n_b FROM k"),
    "a08_first_non_empty": (a08_first_non_empty, "SELECT user_id, arg_min(event_type, event_id) FILTER (event_id%3<>0 AND trim(event_type)<>'') event_type, arg_min(trunc(value)::INT::VARCHAR, event_id) FILTER (event_id%2=0 AND value IS NOT NULL) AS value FROM events GROUP BY 1"),
    "a09_group_collapse": (a09_group_collapse, "SELECT o_custkey platform, o_orderstatus video, arg_min(o_orderpriority, o_orderkey) o_orderpriority FROM orders GROUP BY ALL"),
    "a10_best_run": (a10_best_run, "WITH r AS (SELECT l_suppkey, l_returnflag, count(*) FILTER (l_linestatus='O') richness FROM lineitem GROUP BY ALL) SELECT l_suppkey, l_returnflag, richness FROM r QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY richness DESC, l_returnflag)=1"),
    "a11_distribution_summary": (a11_distribution_summary, _RANK.format(k="o_orderpriority", v="o_totalprice", t="orders") + " SELECT o_orderpriority, count(*) n, min(v) lo, max(v) hi, round(avg(v),2) mean, max(v) FILTER (i=round_even(0.5*(n-1),0)) p50, max(v) FILTER (i=round_even(0.9*(n-1),0)) p90, max(v) FILTER (i=round_even(0.99*(n-1),0)) p99 FROM r GROUP BY 1"),
    "a12_nearest_rank": (a12_nearest_rank, _RANK.format(k="l_returnflag", v="l_quantity", t="lineitem") + " SELECT l_returnflag, p::DOUBLE percent, v FROM r, (SELECT unnest([0,25,50,75,95,100]) p) WHERE i=round_even(p/100.0*(n-1),0)"),
    "a13_capacity": (a13_capacity, """WITH t AS (SELECT l_orderkey, l_returnflag component, sum(trunc(l_extendedprice*10)::BIGINT)::BIGINT total, coalesce(sum(trunc(l_extendedprice*10)::BIGINT) FILTER (l_linestatus<>'O'),0) cpu, coalesce(sum(trunc(l_extendedprice*10)::BIGINT) FILTER (l_linestatus='O'),0) cuda FROM lineitem GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY total)-1 i, count(*) OVER (PARTITION BY component) n FROM t)
      SELECT component, count(*) runs, sum(cpu)::BIGINT cpu_ms, sum(cuda)::BIGINT cuda_ms, max(total) FILTER (i=round_even(0.5*(n-1),0)) p50, max(total) FILTER (i=round_even(0.9*(n-1),0)) p90, max(total) FILTER (i=round_even(0.95*(n-1),0)) p95, max(total) FILTER (i=round_even(0.99*(n-1),0)) p99 FROM r GROUP BY 1"""),
    "a14_component_durations": (a14_component_durations, "SELECT l_returnflag component, count(*) n, min(trunc(l_quantity)::BIGINT) lo, max(trunc(l_quantity)::BIGINT) hi, (sum(trunc(l_quantity)::BIGINT)//count(*))::BIGINT mean_floor, count(*) FILTER (l_linestatus='O') ok, count(*) FILTER (l_linestatus<>'O') other FROM lineitem GROUP BY 1"),
    "a15_fan_out": (a15_fan_out, "SELECT coalesce(o_orderstatus,'all') category, 'o_orderpriority' field, o_orderpriority item, count(*) n FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority),(o_orderpriority))"),
    "a16_channel_concentration": (a16_channel_concentration, "WITH c AS (SELECT o_custkey, count(*) c FROM orders GROUP BY 1) SELECT count(*) n_channels, max(c) top_count, round(max(c)/sum(c),8) top_share, round(sum(c)/count(*),6) per_channel FROM c"),
    "a17_readiness": (a17_readiness, "WITH p AS (SELECT l_orderkey, max((l_linenumber=1)::INT) a, max((l_linenumber=2)::INT) b, max((l_linenumber=3)::INT) c FROM lineitem GROUP BY 1) SELECT count(*) n_keys, sum(a)::BIGINT has_1, sum(b)::BIGINT has_2, sum(c)::BIGINT has_3, count(*) FILTER (a=1 AND b=1 AND c=1) has_all FROM p"),
    "a18_poll_report": (a18_poll_report, "WITH r AS (SELECT i, o_orderdate + to_days(7*i) due, o_orderstatus='F' AND i=1 done FROM orders, (SELECT unnest([1,2,3]) i)) SELECT i, count(*) FILTER (done) done, count(*) FILTER (NOT done AND due<=TIMESTAMP '1998-08-01') due_now, count(*) FILTER (NOT done AND due>TIMESTAMP '1998-08-01') pending, strftime(min(due) FILTER (NOT done AND due>TIMESTAMP '1998-08-01'),'%Y-%m-%d %H:%M:%S') next_due FROM r GROUP BY 1"),
    "a19_inventory": (a19_inventory, " UNION ALL ".join(f"SELECT '{n}' queue, count(*) pending FROM (SELECT DISTINCT o_orderkey FROM orders) WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE {c})" for n, c in (("returned", "l_returnflag = 'R'"), ("accepted", "l_returnflag = 'A'"), ("none", "l_returnflag = 'N'"), ("open", "l_linestatus = 'O'"), ("final", "l_linestatus = 'F'")))),
    "a20_period_stats": (a20_period_stats, "WITH e AS (SELECT event_type, CASE WHEN event_id%4=0 THEN '  ' WHEN event_id%4=1 THEN event_type END code, CASE WHEN event_id%8<6 THEN 'Err'||(event_id%3)||' at step' END error FROM events WHERE ts IS NOT NULL) SELECT coalesce(nullif(trim(code),''), split_part(error,' ',1), 'unknown') error_code, count(*) n, count(DISTINCT event_type) kinds FROM e GROUP BY 1"),
    "a25_feature_stats": (a25_feature_stats, f"WITH l AS ({_UNPIVOT.format(keys='')}) SELECT feature, 0.0::DOUBLE pct_nan, count(DISTINCT value) nunique, false constant, round(avg(value),4) mean, round(stddev_samp(value),4) std, min(value) lo, max(value) hi FROM l GROUP BY 1"),
    "p08_column_profile": (p08_column_profile, "WITH r AS (SELECT unnest(['c_custkey','c_name','c_nationkey','c_acctbal','c_mktsegment']) AS column, unnest([c_custkey::VARCHAR,c_name,c_nationkey::VARCHAR,c_acctbal::VARCHAR,c_mktsegment]) raw FROM customer) SELECT \"column\", round(avg((raw IS NOT NULL AND trim(raw)<>'')::INT),6) nonempty_rate, round(avg((try_cast(raw AS DOUBLE) IS NOT NULL)::INT),6) numeric_rate, CASE WHEN \"column\" LIKE '%key' THEN 'id' ELSE 'feature' END AS role FROM r GROUP BY 1"),
}
