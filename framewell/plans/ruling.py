"""Queries of predicates, rules and batch state."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import values as V
from framewell.operators import balancing as B
from framewell.operators import rules as R
from framewell.operators import stateful as S
from framewell.plans.common import table

_LONG = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def p01_column_filter(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", *(F.col(c).cast("double").alias(c) for c in _LONG)).unpivot(["l_orderkey"], _LONG, "feature", "value")
    return i.where(R.column_filter(F.col("feature"), ["price"], ["_tax"])).groupBy("feature").agg(F.count("*").alias("n"))


def p02_namespace(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", F.lower("l_returnflag").alias("component"), F.lower("l_linestatus").alias("feature"), "l_quantity", "l_linenumber")
    return R.namespace(i, ["l_orderkey"], "component", "feature", "l_quantity", "l_linenumber")


def p03_order(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(*R.stable_order(c.columns, ["c_custkey"]))


def p06_leakage_guard(spark, sf):
    """Feature names made of every part's name and a number, some with the endings and words of later snapshots."""
    kind = F.element_at(F.array(F.lit("views"), F.lit("snapshot"), F.lit("title"), F.lit("")), (F.col("p_partkey") % 4 + 1).cast("int"))
    names = table(spark, sf, "part").select(F.concat(F.translate("p_name", " ", "_"), F.lit("_"), kind, F.lit("_"), (F.col("p_partkey") % 23).cast("string")).alias("name"))
    return names.groupBy("name").agg(F.count("*").alias("n")).select("name", "n", R.leaks(F.col("name"), ["red_widget_views_1"]).alias("leak"))


def p07_leakage_audit(spark, sf):
    f = table(spark, sf, "part").select(F.concat(F.when(F.col("p_partkey") % 3 == 0, "target_").otherwise("f_"), "p_partkey", F.when(F.col("p_partkey") % 5 == 0, "_2").otherwise("")).alias("name"))
    spec = table(spark, sf, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("f_"), "p_partkey").alias("name"))
    return R.leakage_audit(f, "name", spec).groupBy("class").agg(F.count("*").alias("n"))


def _reason():
    return R.first_reason([("no_price", F.col("o_totalprice").isNull()), ("cheap", F.col("o_totalprice") < 20000), ("status", F.col("o_orderstatus") == "P"), ("old", F.col("o_orderdate") < F.expr("timestamp'1993-01-01'"))])


def p09_filter_reason(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", _reason().alias("reason"))


def p10_post_enrich(spark, sf):
    live = R.first_reason([("live", F.col("o_orderpriority") == "1-URGENT"), ("upcoming", F.col("o_orderpriority") == "2-HIGH")])
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(live, _reason()).alias("reason"))


def p11_split(spark, sf):
    return table(spark, sf, "orders").groupBy(_reason().isNull().alias("accepted")).agg(F.count("*").alias("n"))


def p12_age_bucket(spark, sf):
    days = V.seconds_between(F.expr("timestamp'1998-08-02'"), "o_orderdate") / 86400
    return table(spark, sf, "orders").groupBy(R.age_bucket(days, [(1, "lt_1d"), (7, "1d_1w"), (30, "1w_1m"), (365, "1m_1y"), (1095, "1y_3y")], "gt_3y").alias("bucket")).agg(F.count("*").alias("n"))


def p13_numeric_bucket(spark, sf):
    return table(spark, sf, "lineitem").groupBy(R.numeric_bucket(F.when(F.col("l_orderkey") % 10 != 0, F.col("l_quantity")), [(0, 10), (10, 25), (26, 40)]).alias("bucket")).agg(F.count("*").alias("n"))


def p14_age_bucket8(spark, sf):
    hours = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey") * 1.5)
    return table(spark, sf, "orders").groupBy(R.age_bucket(hours, [(6, "0-6h"), (24, "6-24h"), (72, "1-3d"), (168, "3-7d"), (336, "7-14d"), (720, "14-30d"), (2160, "30-90d")], "90d+").alias("bucket")).agg(F.count("*").alias("n"))


def p15_rules(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("component"), F.explode(F.map_from_arrays(F.array(F.lit("balance"), F.lit("nation"), F.lit("name_x")), F.array(F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")), F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))))).alias("column", "raw"))
    rules = spark.createDataFrame([(None, "balance", None, 0.0, 9000.0, None, False), ("BUILDING", "balance", None, -1000.0, 9000.0, None, True), (None, None, "^nation$", None, None, ["1", "2", "3"], False), (None, None, ".*_x$", 0.0, 1.0, None, True)], "component string, column string, pattern string, lo double, hi double, allowed array<string>, optional boolean")
    return R.apply_rules(c, rules).groupBy("column", "warning").agg(F.count("*").alias("n"))


def p17_flatten_meta(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.create_map(F.lit("ok"), F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"), F.lit("ms"), F.col("event_id").cast("string"), F.lit("kind"), F.col("event_type")).alias("meta"))
    return R.flatten_meta(e, "event_id", "meta").groupBy("name").agg(F.sum("number").alias("total"), F.count_distinct("label").alias("labels"))


def p18_leaves(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.struct(F.col("o_totalprice").alias("price"), F.struct(F.col("o_custkey").alias("cust")).alias("ref")).alias("m"))
    return R.numeric_leaves(o, ["o_orderkey"]).groupBy("name").agg(F.round(F.sum("value"), 2).alias("total"))


def p20_due_now(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("i"), "o_orderdate").withColumn("due", F.expr("o_orderdate + make_interval(0, 0, i)"))
    done = table(spark, sf, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("i")).distinct()
    return S.due_entries(o, done, ["o_orderkey", "i"], "due", F.expr("timestamp'1997-01-01'")).select("o_orderkey", "i")


def p21_retention(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderdate") < F.expr("timestamp'1998-08-02' - INTERVAL 365 DAYS")).groupBy("o_orderstatus").agg(F.count("*").alias("expired"))


def p22_containment(spark, sf):
    c = table(spark, sf, "customer").withColumn("m", F.create_map(F.lit("seg"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string")))
    want = F.create_map(F.lit("seg"), F.lit("BUILDING"), F.lit("nation"), F.lit("3"))
    return c.where(R.contains_all(F.col("m"), want)).select("c_custkey")


def t01_first_seen(spark, sf):
    return S.first_seen(table(spark, sf, "events").where("user_id IS NOT NULL").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


def t05_reanchor(spark, sf):
    offsets = spark.createDataFrame([(1, 0.0), (2, 168.0), (3, 336.0), (4, 504.0)], "l_linenumber int, hours double")
    done = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("at"))
    done = done.groupBy("l_orderkey", "l_linenumber").agg(F.max("at").alias("at"))
    return S.reanchor(offsets, done, "l_orderkey", "l_linenumber", "hours", "at").select("l_orderkey", "l_linenumber", F.col("due").cast("string").alias("due"))


def t06_claims(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL AND ts IS NOT NULL").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", "done").when(F.col("event_id") % 11 == 0, "released").otherwise("claimed").alias("status"), (F.col("event_id") * 10).alias("expires"))
    return S.merge_claims(e, "user_id", "event_id", "status", "expires", F.lit(97000)).select("user_id", "event_id", "status")


def t08_accept(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL AND value IS NOT NULL")
    return B.accept(e.select("event_type", "event_id", "user_id", "value"), "event_type", "event_id", "user_id", "value", 8, z=1.5).groupBy("reason").agg(F.count("*").alias("n"))


def t08_balanced_accept(spark, sf):
    """Users as campaigns; event types and value ranges are to be spread, and at most 12 rows of a type accepted."""
    e = table(spark, sf, "events").where("user_id IS NOT NULL")
    shares = {"event_type": B.Share(1.0, max_share=0.5), "value": B.Share(0.8, ((None, 9), (10, 49), (50, None)), [0.5, 0.3, 0.2], unknown_share=0.1)}
    return B.accept(e.select("user_id", "event_id", "event_type", "value"), "user_id", "event_id", "event_type", "value", 12, balance=B.Balance(shares, mode="hard", least=0.6)).select("user_id", "event_id", "score", "reason")


def t09_retries(spark, sf):
    return S.retry_state(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", 5, 30.0)


def t10_rate_limit(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL").select("user_id", (F.col("event_id") * 1.0).alias("t"))
    return S.rate_limit(e, "user_id", "t", 500.0, 5).groupBy("allowed").agg(F.count("*").alias("n"))


def t11_circuit(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL").select("user_id", F.col("event_id").alias("t"), "event_type")
    return S.sliding_failures(e, "user_id", "t", F.col("event_type") == "purchase", 300, 3).select("user_id", "t", "failures", "open")


def t12_transitions(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL").select("user_id", "event_id", "event_type")
    return S.illegal_transitions(e, "user_id", "event_id", "event_type", [("view", "click"), ("click", "purchase"), ("view", "view")])


def t14_stale(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL AND ts IS NOT NULL")
    now = e.agg(F.max("ts")).first()[0]
    return S.stale(e, "user_id", "ts", F.lit(now), 3600.0 * 6).select("user_id")


def t15_checkpoint(spark, sf):
    return table(spark, sf, "events").where("user_id IS NOT NULL").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"), F.count("*").alias("session_rows"))


def t18_idempotent(spark, sf):
    """Of rows with equal line numbers the first of the table."""
    i = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    return S.first_seen(i, ["l_orderkey", "l_suppkey"], "l_linenumber", "file", "place").drop("file", "place")


def a45_balance(spark, sf):
    return S.balance(table(spark, sf, "orders").withColumn("amount", F.floor("o_totalprice")), ["o_custkey"], "amount")


def a46_progress(spark, sf):
    return table(spark, sf, "lineitem").where("l_returnflag <> 'R'").groupBy("l_orderkey").agg(F.round(F.avg("l_discount"), 8).alias("progress"))


def a48_fingerprint(spark, sf):
    c = table(spark, sf, "nation")
    keys = c.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("n_nationkey").cast("string"))), "\n"), 256).alias("key_hash"), F.count("*").alias("n_rows"))
    return keys.withColumn("column_hash", F.sha2(F.lit(",".join(c.columns)), 256))


def f06_balancer(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.round(S.balancer_score(F.col("p_partkey") % 13 / 10.0, F.col("p_partkey") % 5 / 10.0, 0.5), 7).alias("score"))


_REASON = "CASE WHEN o_totalprice IS NULL THEN 'no_price' WHEN o_totalprice<20000 THEN 'cheap' WHEN o_orderstatus='P' THEN 'status' WHEN o_orderdate<TIMESTAMP '1993-01-01' THEN 'old' END"
QUERIES = {
    "p01_column_filter": (p01_column_filter, "SELECT unnest(['l_quantity','l_discount','l_linenumber']) feature, (SELECT count(*) FROM lineitem) n"),
    "p02_namespace": (p02_namespace, "SELECT l_orderkey, lower(l_returnflag)||'__'||lower(l_linestatus) feature, arg_max(l_quantity,(l_linenumber,l_quantity)) l_quantity FROM lineitem GROUP BY 1,2"),
    "p03_order": (p03_order, "SELECT c_custkey, c_acctbal, c_mktsegment, c_name, c_nationkey FROM customer"),
    "p06_leakage_guard": (p06_leakage_guard, "WITH n AS (SELECT replace(p_name,' ','_')||'_'||['views','snapshot','title',''][p_partkey%4+1]||'_'||(p_partkey%23) AS name FROM part) SELECT name, count(*) n, name<>'red_widget_views_1' AND regexp_matches(name,'(_[123]$)|(snapshot_[0-9]+)') leak FROM n GROUP BY 1"),
    "p07_leakage_audit": (p07_leakage_audit, "WITH f AS (SELECT p_partkey k, CASE WHEN p_partkey%3=0 THEN 'target_' ELSE 'f_' END||p_partkey||CASE WHEN p_partkey%5=0 THEN '_2' ELSE '' END AS name FROM part), s AS (SELECT 'f_'||p_partkey AS name FROM part WHERE p_partkey%2=0) SELECT CASE WHEN regexp_matches(name,'(_[123]$)|(snapshot_[0-9]+)') THEN 'forbidden' WHEN name LIKE 'target_%' THEN 'target' WHEN name IN (SELECT name FROM s) THEN 'mapped' ELSE 'unmapped' END AS class, count(*) n FROM f GROUP BY 1"),
    "p09_filter_reason": (p09_filter_reason, f"SELECT o_orderkey, {_REASON} reason FROM orders"),
    "p10_post_enrich": (p10_post_enrich, f"SELECT o_orderkey, CASE WHEN o_orderpriority='1-URGENT' THEN 'live' WHEN o_orderpriority='2-HIGH' THEN 'upcoming' ELSE {_REASON} END reason FROM orders"),
    "p11_split": (p11_split, f"SELECT ({_REASON}) IS NULL accepted, count(*) n FROM orders GROUP BY 1"),
    "p12_age_bucket": (p12_age_bucket, "WITH d AS (SELECT epoch(TIMESTAMP '1998-08-02'-o_orderdate)/86400 d FROM orders) SELECT CASE WHEN d IS NULL THEN 'unknown' WHEN d<1 THEN 'lt_1d' WHEN d<7 THEN '1d_1w' WHEN d<30 THEN '1w_1m' WHEN d<365 THEN '1m_1y' WHEN d<1095 THEN '1y_3y' ELSE 'gt_3y' END bucket, count(*) n FROM d GROUP BY 1"),
    "p13_numeric_bucket": (p13_numeric_bucket, "WITH v AS (SELECT CASE WHEN l_orderkey%10<>0 THEN l_quantity END v FROM lineitem) SELECT CASE WHEN v IS NULL THEN 'unknown' WHEN v BETWEEN 0 AND 10 THEN '00 0-10' WHEN v BETWEEN 10 AND 25 THEN '01 10-25' WHEN v BETWEEN 26 AND 40 THEN '02 26-40' ELSE 'overflow' END bucket, count(*) n FROM v GROUP BY 1"),
    "p14_age_bucket8": (p14_age_bucket8, "WITH v AS (SELECT CASE WHEN o_orderkey%9<>0 THEN o_custkey*1.5 END v FROM orders) SELECT CASE WHEN v IS NULL THEN 'unknown' WHEN v<6 THEN '0-6h' WHEN v<24 THEN '6-24h' WHEN v<72 THEN '1-3d' WHEN v<168 THEN '3-7d' WHEN v<336 THEN '7-14d' WHEN v<720 THEN '14-30d' WHEN v<2160 THEN '30-90d' ELSE '90d+' END bucket, count(*) n FROM v GROUP BY 1"),
    "p15_rules": (p15_rules, """WITH r AS (SELECT c_mktsegment s, 'balance' AS column, CASE WHEN c_custkey%7=0 THEN 'n/a' ELSE c_acctbal::VARCHAR END raw FROM customer UNION ALL SELECT c_mktsegment, 'nation', c_nationkey::VARCHAR FROM customer UNION ALL SELECT c_mktsegment, 'name_x', CASE WHEN c_custkey%2=0 THEN c_name END FROM customer)
      SELECT "column", CASE WHEN raw IS NULL OR raw='n/a' THEN CASE WHEN "column"='name_x' OR s='BUILDING' AND "column"='balance' THEN NULL ELSE 'missing' END WHEN "column"='nation' THEN CASE WHEN raw NOT IN ('1','2','3') THEN 'not_allowed' END WHEN "column"='name_x' THEN 'not_numeric' WHEN raw::DOUBLE>9000 OR raw::DOUBLE<CASE WHEN s='BUILDING' THEN -1000 ELSE 0 END THEN 'out_of_range' END warning, count(*) n FROM r GROUP BY ALL"""),
    "p17_flatten_meta": (p17_flatten_meta, "SELECT 'ok' AS name, sum((event_id%2=0)::INT)::DOUBLE total, 0 labels FROM events UNION ALL SELECT 'ms', sum(event_id)::DOUBLE, 0 FROM events UNION ALL SELECT 'kind', NULL, count(DISTINCT event_type) FROM events"),
    "p18_leaves": (p18_leaves, "SELECT 'm.price' AS name, round(sum(o_totalprice),2) total FROM orders UNION ALL SELECT 'm.ref.cust', sum(o_custkey)::DOUBLE FROM orders"),
    "p20_due_now": (p20_due_now, "WITH o AS (SELECT o_orderkey, unnest([1,2]) i, o_orderdate FROM orders) SELECT o_orderkey, i FROM o WHERE o_orderdate+to_days(7*i)<=TIMESTAMP '1997-01-01' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey=o_orderkey AND l_linenumber=i AND l_linestatus='F')"),
    "p21_retention": (p21_retention, "SELECT o_orderstatus, count(*) expired FROM orders WHERE o_orderdate<TIMESTAMP '1998-08-02'-INTERVAL 365 DAY GROUP BY 1"),
    "p22_containment": (p22_containment, "SELECT c_custkey FROM customer WHERE c_mktsegment='BUILDING' AND c_nationkey=3"),
    "t01_first_seen": (t01_first_seen, "SELECT user_id, event_type, min(event_id) event_id FROM events WHERE user_id IS NOT NULL GROUP BY ALL"),
    "t05_reanchor": (t05_reanchor, "WITH d AS (SELECT l_orderkey k, l_linenumber i, max(l_shipdate) a FROM lineitem GROUP BY ALL), l AS (SELECT k, max(i) i, arg_max(a,i) a FROM d GROUP BY 1) SELECT k l_orderkey, (i+1)::INT l_linenumber, strftime(a+to_days(7),'%Y-%m-%d %H:%M:%S') due FROM l WHERE i<4"),
    "t06_claims": (t06_claims, "WITH e AS (SELECT user_id, event_id, CASE WHEN event_type='purchase' THEN 'done' WHEN event_id%11=0 THEN 'released' ELSE 'claimed' END status FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC)=1) SELECT * FROM e WHERE status='claimed' AND event_id*10>97000"),
    "t08_accept": (t08_accept, None),
    "t08_balanced_accept": (t08_balanced_accept, None),
    "t09_retries": (t09_retries, "SELECT l_orderkey, max(l_linenumber) attempts, max(l_linenumber)*30.0::DOUBLE backoff, max(l_linenumber)>=5 dead FROM lineitem GROUP BY 1"),
    "t10_rate_limit": (t10_rate_limit, "WITH RECURSIVE e AS (SELECT user_id, event_id::DOUBLE AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events WHERE user_id IS NOT NULL), r AS (SELECT DISTINCT user_id, 0::BIGINT AS i, -1e300::DOUBLE AS s, 0 AS used, NULL::BOOLEAN AS allowed FROM e UNION ALL SELECT e.user_id, e.i, CASE WHEN e.t-r.s>=500 THEN e.t ELSE r.s END, CASE WHEN e.t-r.s>=500 THEN 1 ELSE r.used+1 END, e.t-r.s>=500 OR r.used+1<=5 FROM r JOIN e ON e.user_id=r.user_id AND e.i=r.i+1) SELECT allowed, count(*) n FROM r WHERE i>0 GROUP BY 1"),
    "t11_circuit": (t11_circuit, "SELECT user_id, event_id t, (sum((event_type='purchase')::INT) OVER w)::BIGINT failures, sum((event_type='purchase')::INT) OVER w>=3 AS open FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 300 PRECEDING AND CURRENT ROW)"),
    "t12_transitions": (t12_transitions, "WITH e AS (SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) previous, event_type FROM events WHERE user_id IS NOT NULL) SELECT * FROM e WHERE previous<>event_type AND (previous||event_type) NOT IN ('viewclick','clickpurchase')"),
    "t14_stale": (t14_stale, "WITH e AS (SELECT user_id, max(ts) l FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1) SELECT user_id FROM e WHERE epoch((SELECT max(ts) FROM events WHERE user_id IS NOT NULL)-l)>21600"),
    "t15_checkpoint": (t15_checkpoint, "SELECT user_id, arg_max(event_type,event_id) event_type, count(*) session_rows FROM events WHERE user_id IS NOT NULL GROUP BY 1"),
    "t18_idempotent": (t18_idempotent, "SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber)=1"),
    "a45_balance": (a45_balance, "SELECT o_custkey, sum(floor(o_totalprice))::BIGINT balance FROM orders GROUP BY 1"),
    "a46_progress": (a46_progress, "SELECT l_orderkey, round(avg(l_discount),8) progress FROM lineitem WHERE l_returnflag<>'R' GROUP BY 1"),
    "a48_fingerprint": (a48_fingerprint, "SELECT sha256(string_agg(n_nationkey::VARCHAR, chr(10) ORDER BY n_nationkey::VARCHAR)) key_hash, count(*) n_rows, sha256('n_nationkey,n_name,n_regionkey') column_hash FROM nation"),
    "f06_balancer": (f06_balancer, "SELECT p_partkey, CASE WHEN p_partkey%5=0 THEN 1.0 ELSE round(greatest(0,1-0.5*greatest(0,(p_partkey%13/10.0-p_partkey%5/10.0)/(p_partkey%5/10.0)))::DOUBLE,7) END::DOUBLE score FROM part"),
}
