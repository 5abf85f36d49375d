"""Queries of artifact readers and writers. Small files are put at given paths in the shared folder and read back by Spark."""

from __future__ import annotations

import io
import json

import numpy as np
from pyspark.sql import functions as F

from framewell.plans.common import table
from framewell.sources import files as S


def _nations(spark, sf):
    """Key and name of the 25 nations: what the small files are made of."""
    return [(r[0], r[1]) for r in table(spark, sf, "nation").select(F.col("n_nationkey").cast("int"), "n_name").collect()]


def _store(spark, sf):
    """A run folder for each nation; every seventh manifest is broken."""
    root, files = S.scratch(spark), {}
    for key, name in _nations(spark, sf):
        component = lambda c, *kinds: {"name": c, "status": "ok" if key % 2 else "error", "duration_ms": key * 10, "artifacts": [{"type": t, "path": f"{c}/{i}.{t}"} for i, t in enumerate(kinds)]}  # noqa: E731, B023
        body = {"run": {"platform_id": "p", "video_id": name}, "components": [component("clip", "json", "npz", "npz"), component("flow", "json"), component("text", "npz")]}
        files[f"p{key % 3}/{name}/run{key}/manifest.json"] = b"{broken" if key % 7 == 3 else json.dumps(body).encode()
    S.put_files(spark, root, files)
    return root


def s02_run_walk(spark, sf):
    return S.run_manifests(spark, _store(spark, sf)).select("platform", "video_id", "run_id", F.size("components").cast("long").alias("n"))


def s09_run_index(spark, sf):
    rows = S.run_manifests(spark, _store(spark, sf))
    return rows.groupBy("platform").agg(F.count("*").alias("runs"), F.sum(F.aggregate("components", F.lit(0).cast("long"), lambda a, c: a + c["duration_ms"])).alias("ms"))


def s04_component_paths(spark, sf):
    return S.component_paths(S.run_manifests(spark, _store(spark, sf))).select("video_id", "component", "status", "npz")


def _npz(**arrays):
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _artifacts(spark, sf):
    """Three kinds of artifacts: named values, a mapping, loose arrays; every eleventh is no archive."""
    root, files = S.scratch(spark), {}
    for k, name in _nations(spark, sf):
        if k % 3 == 0:
            data = _npz(feature_names=np.array(["area", "bias"]), feature_values=np.array([k, k / 2]))
        elif k % 3 == 1:
            data = _npz(**{"features/speed": np.array(k + 0.5), "meta": np.array(1)})
        else:
            data = _npz(curve=np.array([k, k + 1.0, k + 5.0, np.nan]), none=np.zeros(0))
        files[f"{name}/rs/c{k % 3}/x.npz"] = b"junk" if k % 11 == 10 else data
    S.put_files(spark, root, files)
    return S.artifact_walk(spark, root)


def s03_artifact_walk(spark, sf):
    return _artifacts(spark, sf).select("video_id", "component")


def s05_npz_features(spark, sf):
    return S.npz_features(_artifacts(spark, sf)).select("video_id", "component", "feature", F.round("value", 6).alias("value"))


def _record(o, factor=1):
    return F.format_string('{"snapshot_0":{"viewCount":"%d"}}', F.floor(F.col("o_totalprice") * factor).cast("bigint")).alias("record")


def s07_wanted_ids(spark, sf):
    """Objects by id, a shard for 5,000 orders; only urgent orders are parsed."""
    path = S.scratch(spark)
    o = table(spark, sf, "orders")
    rows = o.select(F.expr("o_orderkey div 5000").alias("shard"), F.concat(F.format_string('"%d":', "o_orderkey"), _record(o)).alias("r"))
    rows.groupBy("shard").agg(F.concat(F.lit("{"), F.concat_ws(",", F.collect_list("r")), F.lit("}")).alias("value")).write.partitionBy("shard").text(path)
    wanted = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").cast("string").alias("video_id"))
    return S.snapshots(S.keyed_records(spark, path, "video_id", wanted), "video_id", [0]).select("video_id", "views")


def s10_last_shard_wins(spark, sf):
    """Two parts that name some ids twice; one is an object, the other a list."""
    root, rows = S.scratch(spark), _nations(spark, sf)
    first = {n: {"v": k} for k, n in rows}
    second = [{"video_id": n, "v": k + 100} for k, n in rows if k % 2 == 0]
    S.put_files(spark, root, {"part_000.json": json.dumps(first).encode(), "part_001.json": json.dumps(second).encode()})
    return S.keyed_records(spark, root, "video_id").select("video_id", F.get_json_object("record", "$.v").cast("int").alias("v"))


def s11_listed_records(spark, sf):
    root = S.scratch(spark)
    S.put_files(spark, root, {"part_000.json": json.dumps([{"video_id": n, "v": k} for k, n in _nations(spark, sf)] + [{"v": 1}]).encode()})
    return S.keyed_records(spark, root, "video_id").select("video_id", F.get_json_object("record", "$.v").cast("int").alias("v"))


def s13_json_lines(spark, sf):
    path = S.scratch(spark) + "/orders.jsonl"
    S.write_table(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), path)
    return S.read_dataset(spark, path, "o_orderkey long, o_orderpriority string").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))


def s14_csv_with_keys(spark, sf):
    path = S.scratch(spark) + "/supplier.csv"
    S.write_table(table(spark, sf, "supplier"), path)
    return S.require_columns(S.read_dataset(spark, path), ["s_suppkey", "s_name"]).select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")


def s15_listing(spark, sf):
    root = S.scratch(spark)
    S.put_files(spark, root, {f"a/{n}.txt": n.encode() for _, n in _nations(spark, sf)})
    return S.list_files(spark, root, "*.txt").select(F.regexp_replace(F.regexp_extract("path", r"([^/]+)[.]txt$", 1), "%20", " ").alias("name"), "length")


def s17_write_table(spark, sf):
    c, path, out = table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), S.scratch(spark), None
    for kind in ("parquet", "csv", "jsonl"):
        S.write_table(c, f"{path}/t.{kind}")
        rows = S.read_dataset(spark, f"{path}/t.{kind}").select(F.lit(kind).alias("kind"), F.col("c_custkey").cast("long").alias("k"), "c_mktsegment")
        out = rows if out is None else out.union(rows)
    return out.groupBy("kind", "c_mktsegment").agg(F.count("*").alias("n"), F.sum("k").alias("keys"))


def s20_result_store(spark, sf):
    path = S.scratch(spark)
    S.write_results(table(spark, sf, "part").select("p_partkey", F.struct("p_name", "p_size").alias("result")), path)
    return spark.read.schema("p_partkey long, result struct<p_name: string, p_size: int>").json(path).select("p_partkey", "result.p_name", F.col("result.p_size").cast("long").alias("p_size"))


def s21_shards(spark, sf):
    path = S.scratch(spark)
    S.write_shards(table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("category")), path, "category", 100)
    rows = spark.read.json(path).select("category", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("category", "file").agg(F.count("*").alias("c")).groupBy("category").agg(F.sum("c").alias("n"), (F.max("c") <= 100).alias("within"))


_OK = "FROM nation WHERE n_nationkey%7<>3"
_CURVE = "SELECT n_name, unnest(['curve__mean','curve__std','curve__min','curve__max','curve__p50','curve__p90','curve__count','none__empty']) f, unnest([n_nationkey+2, sqrt(14/3.0), n_nationkey, n_nationkey+5, n_nationkey+1, n_nationkey+4.2, 3, 1])::DOUBLE v FROM nation WHERE n_nationkey%3=2 AND n_nationkey%11<>10"
QUERIES = {
    "s02_run_walk": (s02_run_walk, f"SELECT 'p'||n_nationkey%3 platform, n_name video_id, 'run'||n_nationkey run_id, 3::BIGINT n {_OK}"),
    "s09_run_index": (s09_run_index, f"SELECT 'p'||n_nationkey%3 platform, count(*) runs, sum(30*n_nationkey)::BIGINT ms {_OK} GROUP BY 1"),
    "s04_component_paths": (s04_component_paths, f"SELECT n_name video_id, unnest(['clip','text']) component, CASE WHEN n_nationkey%2=1 THEN 'ok' ELSE 'error' END status, unnest(['clip/1.npz','text/0.npz']) npz {_OK}"),
    "s03_artifact_walk": (s03_artifact_walk, "SELECT n_name video_id, 'c'||n_nationkey%3 component FROM nation"),
    "s05_npz_features": (s05_npz_features, f"""SELECT n_name video_id, 'c0' component, unnest(['area','bias']) feature, unnest([n_nationkey, n_nationkey/2.0])::DOUBLE AS value FROM nation WHERE n_nationkey%3=0 AND n_nationkey%11<>10
      UNION ALL SELECT n_name, 'c1', 'speed', n_nationkey+0.5 FROM nation WHERE n_nationkey%3=1 AND n_nationkey%11<>10 UNION ALL SELECT n_name, 'c2', f, round(v,6) FROM ({_CURVE})"""),
    "s07_wanted_ids": (s07_wanted_ids, "SELECT o_orderkey::VARCHAR video_id, floor(o_totalprice) AS views FROM orders WHERE o_orderpriority='1-URGENT'"),
    "s10_last_shard_wins": (s10_last_shard_wins, "SELECT n_name video_id, (CASE WHEN n_nationkey%2=0 THEN n_nationkey+100 ELSE n_nationkey END)::INT v FROM nation"),
    "s11_listed_records": (s11_listed_records, "SELECT n_name video_id, n_nationkey::INT v FROM nation"),
    "s13_json_lines": (s13_json_lines, "SELECT o_orderpriority, count(*) n, max(o_orderkey) AS last FROM orders GROUP BY 1"),
    "s14_csv_with_keys": (s14_csv_with_keys, "SELECT s_suppkey, s_name FROM supplier"),
    "s15_listing": (s15_listing, "SELECT n_name AS name, strlen(n_name) AS length FROM nation"),
    "s17_write_table": (s17_write_table, "SELECT k AS kind, c_mktsegment, count(*) n, sum(c_custkey)::BIGINT keys FROM customer, (SELECT unnest(['parquet','csv','jsonl']) k) GROUP BY ALL"),
    "s20_result_store": (s20_result_store, "SELECT p_partkey, p_name, p_size::BIGINT p_size FROM part"),
    "s21_shards": (s21_shards, "SELECT c_mktsegment category, count(*)::BIGINT n, true AS \"within\" FROM customer GROUP BY 1"),
}
