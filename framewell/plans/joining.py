"""Queries of the join idioms and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.operators import joins as J
from framewell.operators import setops as S
from framewell.plans.common import table
from framewell.sources.files import cut


def _t(spark, sf, name):
    return table(spark, sf, name)


def j01_left_targets(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer").where("c_acctbal > 0")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "c_name", "c_acctbal", F.col("c_custkey").isNotNull().alias("matched"))


def j02_inner_last_wins(spark, sf):
    target = _t(spark, sf, "events").select("user_id", "event_id", "value").where("value IS NOT NULL")
    last = J.latest_per_key(target, ["user_id"], [F.desc("event_id")])
    return _t(spark, sf, "customer").join(last, F.col("c_custkey") == F.col("user_id")).select("c_custkey", "event_id", "value")


def j03_semi(spark, sf):
    return _t(spark, sf, "lineitem").join(_t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").selectExpr("o_orderkey AS l_orderkey"), "l_orderkey", "left_semi").groupBy("l_returnflag").agg(F.count("*").alias("n"))


def j04_anti(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey").dropDuplicates(["c_custkey"]).join(_t(spark, sf, "orders").selectExpr("o_custkey AS c_custkey"), "c_custkey", "left_anti")


def j05_snapshot_fields(spark, sf):
    items = _t(spark, sf, "lineitem").where("l_linenumber <= 3").groupBy("l_orderkey").pivot("l_linenumber", [1, 2, 3]).agg(F.max("l_quantity")).toDF("o_orderkey", "snapshot_1", "snapshot_2", "snapshot_3")
    return _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(items, "o_orderkey", "left")


def j07_cell_compare(spark, sf):
    p = _t(spark, sf, "part")
    num = [f.name for f in p.schema if f.dataType.typeName() in ("double", "integer") and f.name != "p_partkey"][:2]
    changed = p.select("p_partkey", *(F.when(F.col("p_partkey") % 50 == 0, F.col(c) * 1.01).when(F.col("p_partkey") % 77 == 0, None).otherwise(F.col(c)).alias(c) for c in num))
    return J.cell_compare(p.select("p_partkey", *num), changed, ["p_partkey"], num, 1e-5, 1e-4).groupBy("reason").agg(F.count("*").alias("n"))


def _frames(spark, sf):
    e = _t(spark, sf, "events").where("ts IS NOT NULL AND user_id IS NOT NULL")
    return e.select("user_id", "event_id", "event_type", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))


_FRAMES = "f AS (SELECT user_id, event_id, event_type, value, epoch_us(ts)/1e6 t FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL)"


def j08_asof_backward(spark, sf):
    f = _frames(spark, sf)
    points = f.where("event_type = 'click'").select("user_id", "t", F.col("event_id").alias("scene"))
    points = points.groupBy("user_id", "t").agg(F.max("scene").alias("scene"))
    return J.asof_backward(f.select("user_id", "t", "event_id"), points, ["user_id"], "t", "scene").select("event_id", "scene")


def j09_interpolate(spark, sf):
    f = _frames(spark, sf)
    points = f.where("event_type = 'click'").groupBy("user_id", "t").agg(F.max("value").alias("value"))
    probes = f.where("event_type = 'view'").select("user_id", "t").distinct()
    return J.interpolate(probes, points, ["user_id"], "t", "value").select("user_id", F.round("t", 3).alias("t"), F.round("value", 4).alias("value"))


def _intervals(spark, sf):
    f = _frames(spark, sf)
    asr = f.where("event_id % 2 = 0").select("user_id", "event_id", F.col("t").alias("a0"), (F.col("t") + 3600 + F.col("event_id") % 5 * 1800).alias("a1"))
    turns = f.where("event_id % 2 = 1").select("user_id", F.col("event_id").alias("turn"), F.col("t").alias("s0"), (F.col("t") + 7200).alias("s1"), F.col("event_type").alias("speaker"))
    return asr, turns


_INTERVALS = _FRAMES + ", asr AS (SELECT user_id, event_id, t a0, t+3600+event_id%5*1800 a1 FROM f WHERE event_id%2=0), turns AS (SELECT user_id, event_id turn, t s0, t+7200 s1, event_type speaker FROM f WHERE event_id%2=1)"


def j10_interval_overlap(spark, sf):
    asr, turns = _intervals(spark, sf)
    return J.interval_overlap(asr, turns, ["user_id"], "a0", "a1", "s0", "s1", 14400.0).select("user_id", "event_id", "turn")


def j11_best_overlap(spark, sf):
    asr, turns = _intervals(spark, sf)
    return J.best_overlap(asr, turns, ["user_id"], "event_id", "a0", "a1", "s0", "s1", "turn", "speaker", 14400.0).select("event_id", "speaker")


def j12_window_join(spark, sf):
    asr, turns = _intervals(spark, sf)
    asr = asr.select("user_id", "event_id", (F.col("a0") - 1).alias("a0"), (F.col("a1") + 1).alias("a1"))
    gpu = turns.select("user_id", F.col("s0").alias("t0"), (F.col("s0")).alias("t1"), "turn")
    hit = J.interval_overlap(asr, gpu.withColumn("t1", F.col("t0") + 1e-6), ["user_id"], "a0", "a1", "t0", "t1", 14400.0)
    return hit.groupBy("event_id").agg(F.count("*").alias("n"), F.max("turn").alias("top"), F.round(F.avg("turn"), 6).alias("mean"))


def j13_covering(spark, sf):
    o, i = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    wanted = i.select(F.col("l_orderkey").alias("k")).join(o.select(F.col("o_orderkey").alias("k")), "k", "left_semi").distinct()
    return J.covering_lookup(wanted, o.select(F.col("o_orderkey").alias("k"), "o_orderstatus"), ["k"]).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def j13_same_keys(spark, sf):
    return J.same_keys(_t(spark, sf, "customer").selectExpr("c_custkey AS k"), _t(spark, sf, "orders").selectExpr("o_custkey AS k"), ["k"])


def j14_due_probe(spark, sf):
    i = _t(spark, sf, "lineitem")
    first = i.where("l_linenumber = 1").select("l_orderkey", "l_shipdate")
    nxt = i.where("l_linenumber = 2").select("l_orderkey")
    return _t(spark, sf, "orders").selectExpr("o_orderkey AS l_orderkey", "o_orderstatus").join(first, "l_orderkey").join(nxt, "l_orderkey", "left_anti").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def j17_overlay(spark, sf):
    base = _t(spark, sf, "lineitem").where("l_linenumber <= 2").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("due"))
    over = _t(spark, sf, "lineitem").where("l_linenumber BETWEEN 2 AND 3").groupBy("l_orderkey", "l_linenumber").agg((-F.min("l_quantity")).alias("due"))
    return J.overlay(base, over, ["l_orderkey", "l_linenumber"], "due", ["l_orderkey"]).groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("due").alias("total"))


def j19_known_keys(spark, sf):
    seen = _t(spark, sf, "events").select(F.col("user_id").alias("k")).where("k IS NOT NULL").distinct()
    return _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment").join(seen, "k", "left_semi").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


def _nearest(spark, sf, only="true"):
    p = _t(spark, sf, "part").select(F.lit(1).alias("g"), (F.col("p_partkey") * 7 % 1009).cast("double").alias("x"), F.col("p_partkey").alias("pos"))
    probes = _t(spark, sf, "supplier").select(F.lit(1).alias("g"), (F.col("s_suppkey") * 10.3).alias("x")).distinct()
    return J.nearest_match(probes, p.where(only), ["g"], "x", "pos").select(F.round("x", 6).alias("x"), "pos")


def j20_nearest(spark, sf):
    return _nearest(spark, sf)


def j20_nearest_all(spark, sf):
    return _nearest(spark, sf)


def u01_union_by_key(spark, sf):
    local, remote = (_t(spark, sf, "orders").where(c).select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("row")) for c in ("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0"))
    return S.union_by_key([local, remote], ["k"], "row")


def u02_distinct_rows(spark, sf):
    a, b = (_t(spark, sf, "lineitem").where(c).select("l_returnflag", "l_linestatus", "l_linenumber") for c in ("l_orderkey % 2 = 0", "l_orderkey % 2 = 1 OR l_orderkey % 3 = 0"))
    return a.union(b).distinct()


def u03_max_merge(spark, sf):
    a, b = (_t(spark, sf, "lineitem").where(c).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.collect_set("l_returnflag").alias("flags")) for c in ("l_linestatus = 'O'", "l_linestatus = 'F'"))
    return S.max_merge(a, b, ["l_suppkey"], ["n"], ["flags"]).select("l_suppkey", "n", F.array_join(F.array_sort("flags"), ",").alias("flags"))


def u04_newer_wins(spark, sf):
    i = _t(spark, sf, "lineitem")
    rows = [i.where(c).select("l_orderkey", F.col("l_shipdate").alias("at"), "l_linenumber") for c in ("l_returnflag = 'N'", "l_returnflag <> 'N'")]
    return S.newer_wins(rows[0], rows[1], ["l_orderkey"], "at", "l_linenumber").select("l_orderkey", F.col("at").cast("string").alias("at"), "l_linenumber")


def u05_intersect(spark, sf):
    i = _t(spark, sf, "lineitem")
    return i.where("l_shipdate < timestamp'1995-01-01'").select("l_partkey").intersect(i.where("l_shipdate >= timestamp'1997-01-01'").select("l_partkey"))


def u06_except(spark, sf):
    return _t(spark, sf, "part").select(F.col("p_partkey").alias("k")).exceptAll(_t(spark, sf, "lineitem").select(F.col("l_partkey").alias("k")).distinct())


def u07_components(spark, sf):
    from framewell.operators.graph import connected_components

    orders = _t(spark, sf, "orders").select((F.col("o_orderkey") + 1_000_000_000).alias("u"), F.col("o_custkey").alias("v"))
    fours = _t(spark, sf, "customer").select(F.col("c_custkey").alias("u"), (F.col("c_custkey") - F.col("c_custkey") % 4).alias("v"))
    edges = orders.union(fours)
    return connected_components(edges, cut)


def u07_keep_one(spark, sf):
    """Part pairs of one type and nearly one price are redundant; the first by price and key of each cluster stays."""
    from framewell.operators.graph import keep_one

    p = _t(spark, sf, "part").select("p_partkey", F.concat_ws("|", "p_type", "p_brand").alias("kind"), "p_retailprice")
    near = Window.partitionBy("kind").orderBy("p_retailprice", "p_partkey")
    pairs = p.withColumn("v", F.lead("p_partkey").over(near)).withColumn("gap", F.lead("p_retailprice").over(near) - F.col("p_retailprice"))
    return keep_one(p, "p_partkey", ["p_retailprice", "p_partkey"], pairs.where("gap < 5").select(F.col("p_partkey").alias("u"), "v"), cut).select("p_partkey")


def u08_incidents(spark, sf):
    return S.merge_incidents(_t(spark, sf, "events").where("user_id IS NOT NULL").select(F.col("user_id").alias("id"), F.col("event_id").alias("seen"), F.col("event_type").alias("batch")), "id", "seen", "batch")


def u09_event_stream(spark, sf):
    f = _frames(spark, sf)
    cuts = f.where("event_type = 'click'").select("user_id", "t", F.lit(1).alias("kind"))
    jumps = f.where("event_type = 'view' AND value > 50").select("user_id", "t", F.lit(200).alias("kind"))
    extra = f.where("event_type = 'purchase'").select("user_id", "t", F.lit(210).alias("kind"))
    return S.event_stream([cuts, jumps, extra], ["user_id"], "t", "kind").select("user_id", F.round("t", 3).alias("t"), "kind", "place")


QUERIES = {
    "u07_keep_one": (u07_keep_one, "SELECT p_partkey FROM part QUALIFY NOT coalesce(p_retailprice - lag(p_retailprice) OVER (PARTITION BY concat_ws('|', p_type, p_brand) ORDER BY p_retailprice, p_partkey) < 5, false)"),
    "j01_left_targets": (j01_left_targets, "SELECT o_orderkey, c_name, c_acctbal, c_custkey IS NOT NULL matched FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal>0) ON o_custkey=c_custkey"),
    "j02_inner_last_wins": (j02_inner_last_wins, "SELECT c_custkey, event_id, value FROM customer JOIN (SELECT * FROM events WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC)=1) ON c_custkey=user_id"),
    "j03_semi": (j03_semi, "SELECT l_returnflag, count(*) n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority='1-URGENT') GROUP BY 1"),
    "j04_anti": (j04_anti, "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)"),
    "j05_snapshot_fields": (j05_snapshot_fields, "SELECT o_orderkey, o_orderstatus, s1 snapshot_1, s2 snapshot_2, s3 snapshot_3 FROM orders LEFT JOIN (SELECT l_orderkey, max(l_quantity) FILTER (l_linenumber=1) s1, max(l_quantity) FILTER (l_linenumber=2) s2, max(l_quantity) FILTER (l_linenumber=3) s3 FROM lineitem WHERE l_linenumber<=3 GROUP BY 1) ON o_orderkey=l_orderkey"),
    "j07_cell_compare": (j07_cell_compare, "WITH c AS (SELECT p_partkey, unnest([p_size::DOUBLE,p_retailprice]) v FROM part) SELECT CASE WHEN p_partkey%50=0 THEN 'value' ELSE 'missing_right' END reason, count(*) n FROM c WHERE v IS NOT NULL AND (p_partkey%50=0 AND abs(v-v*1.01::DOUBLE)>1e-5+1e-4*abs(v*1.01::DOUBLE) OR p_partkey%50<>0 AND p_partkey%77=0) GROUP BY 1"),
    "j08_asof_backward": (j08_asof_backward, f"WITH {_FRAMES}, p AS (SELECT user_id, t, max(event_id) scene FROM f WHERE event_type='click' GROUP BY ALL) SELECT f.event_id, p.scene FROM f ASOF LEFT JOIN p ON f.user_id=p.user_id AND f.t>=p.t"),
    "j09_interpolate": (j09_interpolate, f"""WITH {_FRAMES}, p AS (SELECT user_id, t, max(value) v FROM f WHERE event_type='click' AND value IS NOT NULL GROUP BY ALL), q AS (SELECT DISTINCT user_id, t FROM f WHERE event_type='view'),
      c AS (SELECT user_id, count(*) n FROM p GROUP BY 1), x AS (SELECT q.user_id, q.t, a.t t_a, a.v av FROM q ASOF LEFT JOIN p a ON q.user_id=a.user_id AND q.t>=a.t), y AS (SELECT x.*, b.t bt, b.v bv FROM x ASOF LEFT JOIN p b ON x.user_id=b.user_id AND x.t<=b.t)
      SELECT user_id, round(t,3) t, round(CASE WHEN n>=2 THEN CASE WHEN t_a=bt THEN av WHEN bt>t_a THEN av+(bv-av)*(t-t_a)/(bt-t_a) END END,4) AS value FROM y LEFT JOIN c USING (user_id)"""),
    "j10_interval_overlap": (j10_interval_overlap, f"WITH {_INTERVALS} SELECT a.user_id, event_id, turn FROM asr a JOIN turns s ON a.user_id=s.user_id AND a1>s0 AND a0<s1"),
    "j11_best_overlap": (j11_best_overlap, f"WITH {_INTERVALS}, o AS (SELECT event_id, speaker FROM asr a JOIN turns s ON a.user_id=s.user_id AND a1>s0 AND a0<s1 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY least(a1,s1)-greatest(a0,s0) DESC, turn)=1) SELECT event_id, coalesce(speaker,'unknown') speaker FROM asr LEFT JOIN o USING (event_id)"),
    "j12_window_join": (j12_window_join, f"WITH {_INTERVALS} SELECT event_id, count(*) n, max(turn) top, round(avg(turn),6) mean FROM asr a JOIN turns s ON a.user_id=s.user_id AND s0 BETWEEN a0-1 AND a1+1 GROUP BY 1"),
    "j13_covering": (j13_covering, "SELECT o_orderstatus, count(*) n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1"),
    "j13_same_keys": (j13_same_keys, "WITH a AS (SELECT DISTINCT c_custkey k FROM customer), b AS (SELECT DISTINCT o_custkey k FROM orders), x AS (SELECT (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) only_a, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) only_b) SELECT only_a, only_b, only_a+only_b=0 same FROM x"),
    "j14_due_probe": (j14_due_probe, "SELECT o_orderstatus, count(*) n FROM orders JOIN lineitem a ON o_orderkey=l_orderkey AND l_linenumber=1 WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey=o_orderkey AND b.l_linenumber=2) GROUP BY 1"),
    "j17_overlay": (j17_overlay, "WITH b AS (SELECT l_orderkey k, l_linenumber i, max(l_quantity) d FROM lineitem WHERE l_linenumber<=2 GROUP BY ALL), o AS (SELECT l_orderkey k, l_linenumber i, -min(l_quantity) d FROM lineitem WHERE l_linenumber BETWEEN 2 AND 3 AND l_orderkey IN (SELECT k FROM b) GROUP BY ALL) SELECT i l_linenumber, count(*) n, sum(coalesce(o.d,b.d)) total FROM b FULL JOIN o USING (k,i) GROUP BY 1"),
    "j19_known_keys": (j19_known_keys, "SELECT c_mktsegment, count(*) n FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY 1"),
    "j20_nearest": (j20_nearest, "WITH p AS (SELECT (p_partkey*7%1009)::DOUBLE x, p_partkey pos FROM part), q AS (SELECT s_suppkey*10.3::DOUBLE x FROM supplier) SELECT round(q.x,6) x, arg_min(pos, (abs(p.x-q.x), pos)) pos FROM q, p GROUP BY q.x"),
    "j20_nearest_all": (j20_nearest_all, "WITH p AS (SELECT (p_partkey*7%1009)::DOUBLE x, p_partkey pos FROM part), q AS (SELECT s_suppkey*10.3::DOUBLE x FROM supplier) SELECT round(q.x,6) x, arg_min(pos, (abs(p.x-q.x), pos)) pos FROM q, p GROUP BY q.x"),
    "u01_union_by_key": (u01_union_by_key, "WITH r AS (SELECT o_custkey k, o_orderkey AS row, CASE WHEN o_orderkey%3=0 THEN 0 ELSE 1 END p FROM orders) SELECT k, row FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY p, row DESC)=1"),
    "u02_distinct_rows": (u02_distinct_rows, "SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_orderkey%2=0 UNION SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_orderkey%2=1 OR l_orderkey%3=0"),
    "u03_max_merge": (u03_max_merge, "SELECT l_suppkey, greatest(count(*) FILTER (l_linestatus='O'), count(*) FILTER (l_linestatus='F')) n, array_to_string(list_sort(list(DISTINCT l_returnflag)),',') flags FROM lineitem GROUP BY 1"),
    "u04_newer_wins": (u04_newer_wins, "WITH r AS (SELECT l_orderkey, l_shipdate at_, l_linenumber, CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END p FROM lineitem) SELECT l_orderkey, strftime(at_,'%Y-%m-%d %H:%M:%S') AS \"at\", l_linenumber FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY at_ DESC, p, l_linenumber)=1"),
    "u05_intersect": (u05_intersect, "SELECT l_partkey FROM lineitem WHERE l_shipdate<TIMESTAMP '1995-01-01' INTERSECT SELECT l_partkey FROM lineitem WHERE l_shipdate>=TIMESTAMP '1997-01-01'"),
    "u06_except": (u06_except, "SELECT p_partkey k FROM part EXCEPT SELECT l_partkey FROM lineitem"),
    "u07_components": (u07_components, "WITH RECURSIVE e AS (SELECT o_orderkey+1000000000 u, o_custkey v FROM orders UNION SELECT c_custkey, c_custkey-c_custkey%4 FROM customer WHERE c_custkey%4<>0), b AS (SELECT u,v FROM e UNION ALL SELECT v,u FROM e), r AS (SELECT u node, u reach FROM b UNION SELECT r.node, b.v FROM r JOIN b ON b.u=r.reach) SELECT node, min(reach) component FROM r GROUP BY 1"),
    "u08_incidents": (u08_incidents, "SELECT user_id id, min(event_id) first_seen, max(event_id) last_seen, arg_max(event_type,event_id) last_batch, count(DISTINCT event_type) n_batches, array_to_string(list_sort(list(DISTINCT event_type)),',') batches FROM events WHERE user_id IS NOT NULL GROUP BY 1"),
    "u09_event_stream": (u09_event_stream, f"WITH {_FRAMES}, u AS (SELECT user_id, t, 1 kind FROM f WHERE event_type='click' UNION ALL SELECT user_id, t, 200 FROM f WHERE event_type='view' AND value>50 UNION ALL SELECT user_id, t, 210 FROM f WHERE event_type='purchase') SELECT user_id, round(t,3) t, kind, row_number() OVER (PARTITION BY user_id ORDER BY t, kind)::INT place FROM u"),
}
