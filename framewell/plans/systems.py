"""Queries of sources, streams and learning; files go to the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.operators import learning as L
from framewell.operators import ranks as R
from framewell.sources import bigjson as B
from framewell.sources import files as S
from framewell.streaming import jobs as J
from framewell.plans.common import table


def s01_csv_round_trip(spark, sf):
    path = S.scratch(spark) + "/nation.csv"
    n = table(spark, sf, "nation")
    n.write.csv(path, header=True)
    return S.read_dataset(spark, path).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


def s06_keyed_records(spark, sf):
    return s06_keyed_records_all(spark, sf)


def s06_keyed_records_all(spark, sf):
    """All orders, in shards of up to 10,000."""
    path = S.scratch(spark)
    o = table(spark, sf, "orders")
    key, views, twice = (F.coalesce(c.cast("bigint").cast("string"), F.lit("null")) for c in (F.col("o_orderkey"), F.floor("o_totalprice"), F.floor(F.col("o_totalprice") * 2)))
    record = F.concat(F.lit('"'), key, F.lit('":{"snapshot_0":{"viewCount":"'), views, F.lit('"},"snapshot_1":{"viewCount":"'), twice, F.lit('","likeCount":"x"}}'))
    o = o.select(F.expr("o_orderkey div 10000").alias("shard"), record.alias("record"))
    o.groupBy("shard").agg(F.concat(F.lit("{"), F.concat_ws(",", F.collect_list("record")), F.lit("}")).alias("value")).write.partitionBy("shard").text(path)
    return S.snapshots(S.keyed_records(spark, path, "video_id"), "video_id", [0, 1]).select("video_id", "snapshot_index", "views", "likes")


def s08_incremental_json(spark, sf):
    """Texts, with their quotes, backslashes and braces, as objects by id, a file a partition; read in blocks and compared by hash."""
    path = S.scratch(spark)
    d = table(spark, sf, "documents").where("doc_id IS NOT NULL").select("doc_id", F.to_json(F.struct(F.concat_ws("", F.lit('{"\\'), "text").alias("text"), F.array("lang", "source").alias("of"))).alias("record"))
    B.write_keyed(d.repartition("doc_id"), "doc_id", "record", path)
    r = S.keyed_records(spark, path, "video_id").withColumn("r", F.from_json("record", "text string, of array<string>"))
    return r.select("video_id", F.length("r.text").cast("long").alias("n"), F.md5("r.text").alias("hash"), F.element_at("r.of", 1).alias("lang"))


def s12_partition_value(spark, sf):
    path = S.scratch(spark)
    table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("category")).write.partitionBy("category").json(path)
    return spark.read.json(path).select(S.category_from_path().alias("category"), "c_custkey").groupBy("category").agg(F.count("*").alias("n"))


def s18_sidecar(spark, sf):
    return S.write_with_sidecar(table(spark, sf, "supplier"), S.scratch(spark)).select("n_rows", "n_columns", "column_hash")


def s19_split_export(spark, sf):
    return S.split_export(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 7).groupBy("file").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


def _events(spark, sf):
    rows = table(spark, sf, "events").where("ts IS NOT NULL AND user_id IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
    path = S.scratch(spark)
    rows.repartition(4, "user_id").write.parquet(path)
    return J.file_stream(spark, path, rows.schema)


def t01_stream_dedup(spark, sf):
    return J.run_to_end(J.dedup(_events(spark, sf), ["user_id", "event_type"], "ts", "3650 days")).select("user_id", "event_type")


def t10_stream_windows(spark, sf):
    out = J.run_to_end(J.tumbling(_events(spark, sf), ["event_type"], "ts", "3650 days", "1 day"), "complete")
    return out.select(F.col("start").cast("string").alias("start"), "event_type", "n", F.round("total", 3).alias("total"))


def t16_stream_sessions(spark, sf):
    out = J.run_to_end(J.sessions(_events(spark, sf), ["user_id"], "ts", "3650 days", "6 hours"), "complete")
    return out.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))


def t02_stream_due(spark, sf):
    done = table(spark, sf, "events").where("event_type = 'purchase'").select("user_id", F.expr("event_id div 100").alias("slot")).distinct()
    return J.run_to_end(J.not_completed(_events(spark, sf).withColumn("slot", F.expr("event_id div 100")), done, ["user_id", "slot"])).select("event_id")


def t08_stream_cap(spark, sf):
    stream = _events(spark, sf).select(F.col("user_id").alias("key"), "event_id")
    out = J.run_to_end(J.stateful(stream, "key", "key long, event_id long, accepted boolean", "used long", J.cap_step(10)))
    return out.groupBy("key").agg(F.count("*").alias("n"), F.count_if("accepted").alias("accepted"))


def t09_stream_retries(spark, sf):
    stream = _events(spark, sf).where("event_type = 'purchase'").select(F.col("user_id").alias("key"), "event_id")
    out = J.run_to_end(J.stateful(stream, "key", "key long, attempts long, dead boolean", "n long", J.retry_step(5)))
    return out.groupBy("key").agg(F.max("attempts").alias("attempts"), F.bool_or("dead").alias("dead"))


def _train(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.dayofyear("o_orderdate").cast("double").alias("day"), F.col("o_custkey").cast("double").alias("cust"))
    return L.synthetic_targets(o, "o_orderkey", {"7d": 7.0, "14d": 14.0}, 7)


def l01_fit_predict(spark, sf):
    t = _train(spark, sf)
    out = L.predict(t, L.fit_heads(t, ["o_totalprice", "day", "cust"], {"target_7d": "mask_7d"}, rounds=2, depth=2))
    return out.select("o_orderkey", F.round("pred_target_7d", 6).alias("prediction"))


def l03_out_of_fold(spark, sf):
    t = R.grouped_folds(_train(spark, sf), "o_custkey", 2)
    return L.out_of_fold(t, ["o_totalprice", "day"], "target_7d", "fold", 2, rounds=2, depth=2).groupBy("fold").agg(F.count("*").alias("n"), F.count("pred_target_7d").alias("predicted"))


def l05_select_by_fold(spark, sf):
    i = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_linenumber").cast("double").alias("line"), "l_extendedprice", (F.col("l_orderkey") % 3).cast("int").alias("fold"))
    return L.select_by_fold(i, ["l_quantity", "l_discount", "l_tax", "line"], "l_extendedprice", "fold", 1)


def l07_synthetic(spark, sf):
    return _train(spark, sf).select("o_orderkey", *(F.round(f"target_{h}", 9).alias(f"target_{h}") for h in ("7d", "14d")), "mask_7d", "mask_14d")


def l08_segments(spark, sf):
    """Two values for three segments: the uniform ones."""
    out = L.segment_1d(table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linestatus") == "O").cast("double").alias("v")), "v", 3)
    return out.groupBy("segment").agg(F.count("*").alias("n"))


def l08_segments_all(spark, sf):
    """All values: more than k are distinct, so that k-means runs."""
    out = L.segment_1d(table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("double").alias("v")), "v", 3)
    return out.groupBy("v", "segment").agg(F.count("*").alias("n"))


def l11_topo(spark, sf):
    """Nations need their region; asked for are nations of even keys. The graph is as small as the components of a system are."""
    regions = {r["r_regionkey"]: f"R {r['r_name']}" for r in table(spark, sf, "region").collect()}
    nations = [(r["n_nationkey"], f"N {r['n_name']}", r["n_regionkey"]) for r in table(spark, sf, "nation").collect()]
    graph = {name: [] for name in regions.values()} | {name: [regions[region]] for _, name, region in nations}
    order = L.topo_order(graph, [name for key, name, _ in nations if key % 2 == 0])
    return spark.createDataFrame(list(enumerate(order)), "place long, name string")


def l12_similarity(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 10 / 10.0).alias("a"), (F.col("p_partkey") % 7 / 7.0).alias("b"))
    return p.select("p_partkey", F.round(L.weighted_score({"a": 0.6, "b": 0.4}), 7).alias("score"))


def l15_melt(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("clip"), F.when(F.col("c_custkey") % 3 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("flow"))
    return L.melt_index(c, ["c_custkey"], ["clip", "flow"])


def s25_subtitles(spark, sf):
    from framewell.operators.textual import parse_subtitle

    c = table(spark, sf, "customer").select("c_custkey", F.element_at(F.array(F.lit("vtt"), F.lit("json3"), F.lit("xml")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("ext"), F.col("c_mktsegment").alias("w"))
    body = F.when(F.col("ext") == "vtt", F.concat(F.lit("WEBVTT\n\n1\n00:01.000 --> 00:02.000\n<c>"), "w", F.lit("</c>\n\n00:02.000 --> 00:03.000\n"), "w", F.lit("\nend")))
    body = body.when(F.col("ext") == "json3", F.concat(F.lit('{"events":[{"segs":[{"utf8":"'), "w", F.lit('"},{"utf8":" end"}]},{"t":1}]}')))
    c = c.withColumn("payload", body.otherwise(F.concat(F.lit("<transcript><text>"), "w", F.lit("</text><text>end</text></transcript>"))))
    return c.select("c_custkey", parse_subtitle("payload", "ext").alias("text"))


_E = "events WHERE ts IS NOT NULL AND user_id IS NOT NULL"
_U = "(('0x'||substr(sha256('7{}:'||o_orderkey),1,13))::UBIGINT::DOUBLE/4503599627370496.0::DOUBLE)"
QUERIES = {
    "s01_csv_round_trip": (s01_csv_round_trip, "SELECT n_nationkey, n_name FROM nation"),
    "s06_keyed_records": (s06_keyed_records, "SELECT o_orderkey::VARCHAR video_id, unnest([0,1]) snapshot_index, unnest([floor(o_totalprice),floor(o_totalprice*2)])::DOUBLE AS views, NULL::DOUBLE likes FROM orders"),
    "s06_keyed_records_all": (s06_keyed_records_all, "SELECT o_orderkey::VARCHAR video_id, unnest([0,1]) snapshot_index, unnest([floor(o_totalprice),floor(o_totalprice*2)])::DOUBLE AS views, NULL::DOUBLE likes FROM orders"),
    "s08_incremental_json": (s08_incremental_json, r"""SELECT doc_id::VARCHAR video_id, length('{"\'||coalesce(text,'')) n, md5('{"\'||coalesce(text,'')) AS hash, lang FROM documents WHERE doc_id IS NOT NULL"""),
    "s12_partition_value": (s12_partition_value, "SELECT c_mktsegment category, count(*) n FROM customer GROUP BY 1"),
    "s18_sidecar": (s18_sidecar, "SELECT count(*) n_rows, (SELECT count(*) FROM information_schema.columns WHERE table_name='supplier') n_columns, sha256((SELECT string_agg(column_name, ',' ORDER BY ordinal_position) FROM information_schema.columns WHERE table_name='supplier')) column_hash FROM supplier"),
    "s19_split_export": (s19_split_export, "WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey)-1 i, ceil(count(*) OVER ()/7.0) e FROM customer) SELECT floor(i/e)::INT file, count(*) n, min(c_custkey) AS first FROM r GROUP BY 1"),
    "s25_subtitles": (s25_subtitles, "SELECT c_custkey, c_mktsegment||CASE WHEN c_custkey%3=0 THEN ' end' ELSE ' end' END AS text FROM customer"),
    "t01_stream_dedup": (t01_stream_dedup, f"SELECT DISTINCT user_id, event_type FROM {_E}"),
    "t10_stream_windows": (t10_stream_windows, f"SELECT strftime(date_trunc('day',ts),'%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) n, round(sum(value),3) total FROM {_E} GROUP BY ALL"),
    "t16_stream_sessions": (t16_stream_sessions, f"WITH e AS (SELECT user_id, CASE WHEN ts-lag(ts) OVER (PARTITION BY user_id ORDER BY ts)<INTERVAL 6 HOUR THEN 0 ELSE 1 END s FROM {_E}) SELECT user_id, sum(s)::BIGINT sessions, count(*) n FROM e GROUP BY 1"),
    "t02_stream_due": (t02_stream_due, f"SELECT event_id FROM {_E} AND (user_id, event_id//100) NOT IN (SELECT (user_id, event_id//100) FROM events WHERE event_type='purchase' AND user_id IS NOT NULL)"),
    "t08_stream_cap": (t08_stream_cap, f"SELECT user_id AS key, count(*) n, least(count(*),10) accepted FROM {_E} GROUP BY 1"),
    "t09_stream_retries": (t09_stream_retries, f"SELECT user_id AS key, count(*) attempts, count(*)>=5 dead FROM {_E} AND event_type='purchase' GROUP BY 1"),
    "l01_fit_predict": (l01_fit_predict, None),
    "l03_out_of_fold": (l03_out_of_fold, None),
    "l05_select_by_fold": (l05_select_by_fold, """WITH t AS (SELECT f.fold, l_extendedprice y, unnest(['l_quantity','l_discount','l_tax','line']) feature, unnest([l_quantity,l_discount,l_tax,l_linenumber::DOUBLE]) x FROM lineitem JOIN (SELECT unnest([0,1,2]) fold) f ON l_orderkey%3<>f.fold),
      r AS (SELECT fold, feature, rank() OVER (PARTITION BY fold, feature ORDER BY x)+(count(*) OVER (PARTITION BY fold, feature, x)-1)/2.0 rx, rank() OVER (PARTITION BY fold, feature ORDER BY y)+(count(*) OVER (PARTITION BY fold, feature, y)-1)/2.0 ry FROM t),
      s AS (SELECT fold, feature, round(abs(corr(rx,ry)),9) s FROM r GROUP BY ALL) SELECT fold::INT fold, 1::INT AS rank, feature FROM s QUALIFY row_number() OVER (PARTITION BY fold ORDER BY s DESC, feature)=1"""),
    "l07_synthetic": (l07_synthetic, f"SELECT o_orderkey, round(5+3*{_U.format('base')}+ln(8.0::DOUBLE)*(0.5+{_U.format('7d')}),9) target_7d, round(5+3*{_U.format('base')}+ln(15.0::DOUBLE)*(0.5+{_U.format('14d')}),9) target_14d, ({_U.format('m7d')}<0.9)::INT::DOUBLE mask_7d, ({_U.format('m14d')}<0.9)::INT::DOUBLE mask_14d FROM orders"),
    "l08_segments": (l08_segments, "SELECT CASE l_linestatus WHEN 'O' THEN 2 ELSE 0 END segment, count(*) n FROM lineitem GROUP BY 1"),
    "l08_segments_all": (l08_segments_all, None),
    "l11_topo": (l11_topo, "WITH n AS (SELECT 'N '||n_name AS name, 'R '||r_name AS region FROM nation JOIN region ON r_regionkey=n_regionkey WHERE n_nationkey%2=0), o AS (SELECT DISTINCT 0 AS level, region AS name FROM n UNION ALL SELECT 1, name FROM n) SELECT row_number() OVER (ORDER BY level, name)-1 AS place, name FROM o"),
    "l12_similarity": (l12_similarity, "SELECT p_partkey, round(CASE WHEN p_partkey%2=0 THEN 0.6*(p_partkey%10/10.0)+0.4*(p_partkey%7/7.0) ELSE p_partkey%7/7.0 END::DOUBLE,7) score FROM part"),
    "l15_melt": (l15_melt, "SELECT c_custkey, 'clip' component, c_name path FROM customer WHERE c_custkey%2=0 UNION ALL SELECT c_custkey, 'flow', c_mktsegment FROM customer WHERE c_custkey%3<>0"),
}
