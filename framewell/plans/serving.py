"""Queries of polling, confirmed flushes, leases, saved models, tracks and registered functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import registered as G
from framewell.operators import learning as L
from framewell.operators import profile as P
from framewell.operators import stateful as B
from framewell.operators.tracking import assign_tracks
from framewell.plans.common import table
from framewell.plans.systems import _train
from framewell.sources import files as S
from framewell.streaming import jobs as J


def _stream(spark, sf, rows, files=1):
    path = S.scratch(spark)
    rows.repartition(4).write.parquet(path)
    return J.file_stream(spark, path, rows.schema, files)


def t03_poll_due(spark, sf):
    """One round of the poll: entries that are due and not done, in several micro-batches."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return J.run_to_end(J.not_completed(_stream(spark, sf, o), done, ["o_orderkey"]).where("o_orderdate <= timestamp'1997-01-01'")).select("o_orderkey")


def t04_confirmed_flush(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return J.run_confirmed(_stream(spark, sf, o), S.scratch(spark)).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("orders"))


def t07_leases(spark, sf):
    """Users as leases, event types as owners; every fourth row of an owner releases."""
    e = table(spark, sf, "events").where("ts IS NOT NULL AND user_id IS NOT NULL").select(F.col("user_id").alias("key"), "event_id", F.col("event_type").alias("owner"), F.when(F.col("event_id") % 4 == 0, "release").when(F.col("event_id") % 4 == 1, "heartbeat").otherwise("acquire").alias("action"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    return J.run_to_end(J.stateful(_stream(spark, sf, e, 100), "key", "key long, event_id long, granted boolean", "owner string, until double", J.lease_step(86400.0)))


def t13_priorities(spark, sf):
    """Three queues as priorities, each consumed to its end and acknowledged by batch; a consumer that comes back finds nothing."""
    out = None
    for rank, name in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM")):
        rows = table(spark, sf, "orders").where(F.col("o_orderpriority") == name).select("o_orderkey")
        stream, folder = _stream(spark, sf, rows), S.scratch(spark)
        J.run_confirmed(stream, folder)
        got = J.run_confirmed(stream, folder).agg(F.lit(rank).alias("priority"), F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("orders"))
        out = got if out is None else out.union(got)
    return out


def t17_readiness(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", (7 * (1 + F.col("o_orderkey") % 3)).cast("int").alias("day"))
    return P.readiness(o, "o_custkey", "day", [7, 14, 21])


def t14_stale_leases(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL AND ts IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
    last = e.agg(F.max("ts")).first()[0]
    return B.stale(e, "user_id", "ts", F.lit(last), 86400.0).select("user_id")


def l02_saved_bundle(spark, sf):
    t, path = _train(spark, sf), S.scratch(spark)
    L.save_models(L.fit_heads(t, ["o_totalprice", "day", "cust"], {"target_7d": "mask_7d"}, rounds=2, depth=2), path)
    return L.predict(t, L.load_models(path, ["target_7d"])).select("o_orderkey", F.round("pred_target_7d", 6).alias("prediction"))


def l06_permutation_importance(spark, sf):
    t = _train(spark, sf).withColumn("target", F.col("day") * 2 + F.col("o_totalprice") / 1e6).withColumn("on", F.lit(1))
    model = L.fit_heads(t, ["o_totalprice", "day", "cust"], {"target": "on"}, rounds=3, depth=3)["target"]
    return L.permutation_importance(t, model, ["day", "cust"], "target", "o_orderkey").select("feature", F.round("importance", 6).alias("importance"))


def j18_tracks(spark, sf):
    """Labels as videos, four vectors a frame."""
    e = table(spark, sf, "embeddings").where("embedding IS NOT NULL")
    d = e.select("label", F.expr("vec_id div 80").alias("frame"), F.col("vec_id").alias("slot"), "embedding", (F.col("vec_id") % 10 / 10.0).alias("x"), (F.col("vec_id") % 4 / 4.0).alias("y"))
    return assign_tracks(d, "label", "frame", "slot", "embedding", "x", "y").select("label", "frame", "slot", "track")


def x05_registered(spark, sf):
    G.register(spark)
    table(spark, sf, "customer").createOrReplaceTempView("framewell_customer")
    return spark.sql("SELECT w.word, count(*) AS n, round(max(framewell_unit_hash(c.c_name)), 9) AS u FROM framewell_customer c, LATERAL framewell_words(c.c_mktsegment) w GROUP BY w.word")


class _Length:
    name, requires = "length", ()

    def extract(self, df):
        return df.select("doc_id", F.lit("bytes").alias("feature"), F.octet_length("text").cast("double").alias("value"))


class _Words:
    name, requires = "words", ("length",)

    def extract(self, df):
        return df.select("doc_id", F.lit("spaces").alias("feature"), F.regexp_count("text", F.lit(" ")).cast("double").alias("value"))


def x01_extractors(spark, sf):
    return G.run_extractors(table(spark, sf, "documents"), [_Words(), _Length()], "doc_id")


QUERIES = {
    "t03_poll_due": (t03_poll_due, "SELECT o_orderkey FROM orders WHERE o_orderstatus<>'F' AND o_orderdate<=TIMESTAMP '1997-01-01'"),
    "t04_confirmed_flush": (t04_confirmed_flush, "SELECT o_orderpriority, count(*) n, count(DISTINCT o_orderkey) orders FROM orders GROUP BY 1"),
    "t07_leases": (t07_leases, None),
    "t13_priorities": (t13_priorities, "SELECT substr(o_orderpriority,1,1)::INT-1 priority, count(*) n, count(DISTINCT o_orderkey) orders FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') GROUP BY 1"),
    "t17_readiness": (t17_readiness, "WITH p AS (SELECT o_custkey, max((o_orderkey%3=0)::INT) a, max((o_orderkey%3=1)::INT) b, max((o_orderkey%3=2)::INT) c FROM orders GROUP BY 1) SELECT count(*) n_keys, sum(a)::BIGINT has_7, sum(b)::BIGINT has_14, sum(c)::BIGINT has_21, count(*) FILTER (a=1 AND b=1 AND c=1) has_all FROM p"),
    "t14_stale_leases": (t14_stale_leases, "SELECT user_id FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1 HAVING epoch_us((SELECT max(ts) FROM events WHERE user_id IS NOT NULL))-epoch_us(max(ts))>86400000000"),
    "l02_saved_bundle": (l02_saved_bundle, None),
    "l06_permutation_importance": (l06_permutation_importance, None),
    "j18_tracks": (j18_tracks, None),
    "x01_extractors": (x01_extractors, "SELECT doc_id, unnest(['length','words']) component, unnest(['bytes','spaces']) feature, unnest([strlen(text),length(text)-length(replace(text,' ',''))])::DOUBLE AS value FROM documents"),
    "x05_registered": (x05_registered, "SELECT c_mktsegment word, count(*) n, round(max(('0x'||substr(sha256(c_name),1,16))::UBIGINT::DOUBLE/18446744073709551616.0),9) u FROM customer GROUP BY 1"),
}
