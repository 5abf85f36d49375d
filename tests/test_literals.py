"""Hand-worked cases: missing values, ties, single rows, edges and empty inputs."""

import io
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewell.functions import values as V
from framewell.operators import balancing, graph, joins, learning, profile, ranks, rules, sequences, setops, stateful, textual, vectors
from framewell.sources import files
from framewell.streaming import jobs

INF = float("inf")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_log_targets(spark):
    rows = [(10.0, 13.0), (10.0, 7.0), (1.0, None), (float("nan"), 3.0), (INF, 3.0)]
    out = [r[0] for r in frame(spark, rows, "a double, b double").select(V.log1p_delta("b", "a")).collect()]
    assert out[0] == pytest.approx(math.log(4)) and out[1:] == [0.0, None, None, None]


def test_lenient_numbers(spark):
    raw = ["1 234,5", "n/a", "", None, "nan", "inf", "12.7", "abc", "-3"]
    df = frame(spark, [(r,) for r in raw], "s string").select(V.lenient_double("s"), V.lenient_finite("s"), V.lenient_bigint("s"), V.empty_like("s"))
    out = df.collect()
    assert out[0][:2] == (1234.5, 1234.5) and math.isnan(out[4][0]) and out[4][1] is None and out[5][0] == INF and out[5][1] is None
    assert [r[2] for r in out] == [None, None, None, None, None, None, None, None, -3] and [r[3] for r in out] == [False, True, True, True, False, False, False, False, False]


def test_array_summary(spark):
    df = frame(spark, [("a", 2.0), ("a", 4.0), ("a", 9.0), ("a", float("nan")), ("b", float("nan")), ("c", None)], "k string, value double")
    out = {r.k: r for r in profile.array_summary(df, ["k"]).collect()}
    assert (out["a"].mean, out["a"].p50, out["a"].p90, out["a"].n) == (5.0, 4.0, 8.0, 3) and out["a"]["std"] == pytest.approx(2.943920, abs=1e-6)
    assert out["b"].all_non_finite and not out["b"].is_empty and out["c"].is_empty and out["c"].mean is None


def test_ranks_and_spearman(spark):
    df = frame(spark, [(1.0,), (2.0,), (2.0,), (5.0,)], "v double")
    assert sorted((r.v, r["rank"]) for r in ranks.average_rank(df, [], "v").collect()) == [(1.0, 1.0), (2.0, 2.5), (2.0, 2.5), (5.0, 4.0)]
    assert ranks.spearman(frame(spark, [(1.0, 1.0), (1.0, 2.0)], "x double, y double"), [], "x", "y").first().spearman is None


def test_ks(spark):
    a, b = (frame(spark, [("f", float(x)) for x in v], "feature string, value double") for v in ([1, 2], [3, 4]))
    assert profile.ks_two_sample(a, b, ["feature"]).first().ks == 1.0
    assert profile.ks_two_sample(a.limit(1), b, ["feature"]).first().ks is None


def test_nearest_rank_both_forms(spark):
    df = frame(spark, [("g", x) for x in (10.0, 20.0, 30.0, 40.0)], "g string, v double")
    assert profile.nearest_rank_table(df, ["g"], "v", [50]).first().v == 30.0


def test_health(spark):
    one = spark.range(1).select(profile.health(F.lit(0.5), F.lit(0.0), F.lit(1.0), F.lit(False)).alias("h"), profile.severity(F.lit(80.0)).alias("s")).first()
    assert one.h == 80.0 and one.s == "low"


def test_quality_counts_missing_kinds(spark):
    df = frame(spark, [("f", 1.0), ("f", float("nan")), ("f", INF), ("f", None)], "feature string, value double")
    r = profile.feature_quality(df, ["feature"]).first()
    assert (r.n_rows, r.n_present, r.n_finite, r.coverage, r.is_constant) == (4, 3, 1, 0.75, True) and r.nan_rate == pytest.approx(1 / 3)


def test_allocation_and_segments(spark):
    w = frame(spark, [("a", 3), ("b", 2), ("c", 2)], "n string, w int")
    assert {r.n: r["count"] for r in ranks.allocate(w, "n", "w", 10).collect()} == {"a": 5, "b": 3, "c": 2}
    seg = sequences.uniform_segments(spark.range(11).withColumn("k", F.lit(1)), ["k"], "id", 5).groupBy("segment").count().orderBy("segment")
    assert [r["count"] for r in seg.collect()] == [2, 2, 2, 2, 3]


def test_joins_on_edges(spark):
    points = frame(spark, [(1, 10.0, "s0"), (1, 20.0, "s1")], "k int, t double, s string")
    probes = frame(spark, [(1, t, i) for i, t in enumerate([5.0, 10.0, 15.0, 20.0, 99.0])], "k int, t double, i int")
    got = {r.i: r.s for r in joins.asof_backward(probes, points, ["k"], "t", "s").collect()}
    assert got == {0: None, 1: "s0", 2: "s0", 3: "s1", 4: "s1"}
    assert {r.s for r in joins.asof_backward(probes.where("i = 0"), points, ["k"], "t", "s", clip_first=True).collect()} == {"s0"}
    curve = frame(spark, [(1, 1.0, 10.0), (1, 3.0, 30.0)], "k int, t double, v double")
    ask = frame(spark, [(1, 0.0), (1, 1.0), (1, 2.0), (1, 4.0)], "k int, t double")
    assert [r.v for r in joins.interpolate(ask, curve, ["k"], "t", "v").orderBy("t").collect()] == [None, 10.0, 20.0, None]
    assert [r.v for r in joins.interpolate(ask, curve.limit(1), ["k"], "t", "v").collect()] == [None] * 4
    a, b = frame(spark, [(1, 1.0, 2.0)], "k int, a0 double, a1 double"), frame(spark, [(1, 0.0, 1.0)], "k int, b0 double, b1 double")
    assert joins.interval_overlap(a, b, ["k"], "a0", "a1", "b0", "b1", 10.0).count() == 0
    near = joins.nearest_match(frame(spark, [(1, 2.0), (1, 9.0)], "k int, x double"), frame(spark, [(1, 1.0, 0), (1, 3.0, 1)], "k int, x double, p int"), ["k"], "x", "p")
    assert {r.x: r.p for r in near.collect()} == {2.0: 0, 9.0: 1}
    with pytest.raises(Exception, match="no provider row"):
        joins.covering_lookup(frame(spark, [(1,), (2,)], "k int"), frame(spark, [(1, "x")], "k int, v string"), ["k"]).collect()


def test_interval_overlap_counts_each_pair_once(spark):
    rng = np.random.default_rng(1)
    a, b = ([(1, i, float(s), float(s + d)) for i, (s, d) in enumerate(zip(rng.uniform(0, 100, 40), rng.uniform(0, 30, 40)))] for _ in range(2))
    got = joins.interval_overlap(frame(spark, a, "k int, i int, a0 double, a1 double"), frame(spark, b, "k int, j int, b0 double, b1 double"), ["k"], "a0", "a1", "b0", "b1", 7.0).select("i", "j").collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for _, i, s, e in a for _, j, u, v in b if e > u and s < v)


def test_components(spark):
    edges = frame(spark, [(1, 2), (2, 3), (5, 6), (7, 7), (None, 1)] + [(10, x) for x in range(11, 40)], "u long, v long")
    got = {r.node: r.component for r in graph.connected_components(edges, lambda d: d.cache()).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, **dict.fromkeys(range(10, 40), 10)}
    assert graph.connected_components(edges.limit(0), lambda d: d.cache()).collect() == []


def test_sequences(spark):
    curve = frame(spark, [(1, float(t), v) for t, v in enumerate([0.0, 5.0, 1.0, 4.0, 0.0, 9.0, 0.0])], "k int, t double, v double")
    peaks = sequences.local_peaks(curve, ["k"], "t", "v")
    assert sorted(r.t for r in sequences.suppress_by_time(peaks, ["k"], "t", "v", 3.0).collect()) == [1.0, 5.0]
    assert sequences.climax(curve, ["k"], "t", "v").first().position == pytest.approx(5 / 6)
    assert sequences.position(curve.limit(1), ["k"], "t").first().position == 0.0
    chunks = sequences.chunk_by_budget(frame(spark, [(1, i, 4) for i in range(5)], "k int, i long, n long"), ["k"], "i", "n", 10, 1).orderBy("chunk").collect()
    assert [(r["first"], r["last"]) for r in chunks] == [(0, 1), (1, 2), (2, 3), (3, 4)]
    wave = frame(spark, [(1, i, math.sin(2 * math.pi * i / 8)) for i in range(64)], "k int, i int, v double")
    assert sequences.periodicity(wave, ["k"], "i", "v").first().period == 8.0


def test_setops_and_state(spark):
    a, b = frame(spark, [(1, 5, 10)], "k int, at int, v int"), frame(spark, [(1, 5, 20), (2, 1, 3)], "k int, at int, v int")
    assert {r.k: r.v for r in setops.newer_wins(a, b, ["k"], "at", "v").collect()} == {1: 20, 2: 3}
    claims = frame(spark, [("a", 1, "claimed", 10), ("a", 2, "released", 10), ("a", 3, "claimed", 10), ("b", 1, "claimed", 1), ("c", 1, "done", 10)], "k string, o int, s string, e int")
    assert [r.k for r in stateful.merge_claims(claims, "k", "o", "s", "e", F.lit(5)).collect()] == ["a"]
    hits = frame(spark, [("a", float(t)) for t in (0, 1, 2, 9, 11, 12)], "k string, t double")
    assert [r.allowed for r in stateful.rate_limit(hits, "k", "t", 10.0, 3).orderBy("t").collect()] == [True, True, True, False, True, True]
    rows = frame(spark, [("g", i, "c" if i < 30 else "d", 1.0 + i % 2) for i in range(40)] + [("g", 40, "e", 500.0)], "g string, o int, c string, v double")
    out = {r.o: r.reason for r in balancing.accept(rows, "g", "o", "c", "v", 25).collect()}
    assert out[40] == "outlier" and out[26] == "channel_cap" and out[31] is None


def test_rules_and_columns(spark):
    assert rules.kept_columns(["a__price", "b__x_raw", "c"], ["price"], ["_raw"]) == ["c"] and rules.leakage_guard(["v_0", "v_2", "snapshot_1_x"]) == ["v_2", "snapshot_1_x"]
    b = spark.range(1).select(rules.numeric_bucket(F.lit(10.0), [(0, 10), (10, 20)]), rules.numeric_bucket(F.lit(10.5), [(0, 10), (11, 20)])).first()
    assert tuple(b) == ("00 0-10", "overflow")


def test_vectors(spark):
    df = frame(spark, [(1, [3.0, 4.0], [4.0, 3.0]), (2, [0.0, 0.0], [1.0, 0.0]), (3, [1.0], [1.0, 0.0]), (4, None, [1.0]), (5, [float("nan"), 1.0], [1.0, 1.0])], "i int, a array<double>, b array<double>")
    out = {r.i: (r.c, r.f) for r in df.select("i", vectors.cosine("a", "b").alias("c"), vectors.cosine_flag("a", "b").alias("f")).collect()}
    assert out[1][0] == pytest.approx(0.96) and [out[i] for i in (2, 3, 4, 5)] == [(None, "zero_norm"), (None, "dimension"), (None, "missing"), (None, "non_finite")]
    g = frame(spark, [(i, [1.0, float(i)]) for i in range(4)], "g int, v array<double>")
    assert vectors.top_k_cosine(g.where("g = 0").withColumnRenamed("g", "q"), g, "q", "g", "v", 10).count() == 4


def test_text(spark):
    r = spark.range(1).select(textual.hashtags(F.lit("#One x#no #two #one ##three")).alias("h"), textual.sentences(F.lit("A b. C? ")).alias("s")).first()
    assert r.h == ["one", "two"] or r.h[:2] == ["one", "two"]
    assert r.s == ["A b", "C"]
    empty = textual.lexical_pack(frame(spark, [(None,)], "t string"), "t").first()
    assert empty.n_words == 0 and empty.type_token == 0.0


def test_npz_preference():
    def npz(**k):
        out = io.BytesIO()
        np.savez(out, **k)
        return out.getvalue()

    assert files.npz_rows(npz(feature_names=np.array(["a", "b"]), feature_values=np.array([1.0, 2.0], "f4"), x=np.ones(3))) == [("a", 1.0), ("b", 2.0)]
    loose = dict(files.npz_rows(npz(x=np.array([2.0, 4.0, 9.0, np.nan]), e=np.zeros(0), n=np.array([np.nan]), s=np.array(3))))
    assert loose["x__p90"] == 8.0 and loose["x__count"] == 3 and loose["e__empty"] == 1.0 and loose["n__all_non_finite"] == 1.0 and loose["s"] == 3.0
    assert files.npz_rows(b"no archive") == []


def test_sources(spark, tmp_path):
    run = tmp_path / "yt" / "v1" / "r1"
    run.mkdir(parents=True)
    (run / "manifest.json").write_text('{"run": {"video_id": "v1"}, "components": [{"name": "clip", "status": "ok", "duration_ms": 5, "artifacts": [{"type": "json", "path": "a"}, {"type": "npz", "path": "b.npz"}]}]}')
    bad = tmp_path / "yt" / "v2" / "r1"
    bad.mkdir(parents=True)
    (bad / "manifest.json").write_text("{broken")
    got = files.component_paths(files.run_manifests(spark, str(tmp_path))).collect()
    assert [(r.platform, r.video_id, r.run_id, r.component, r.npz) for r in got] == [("yt", "v1", "r1", "clip", "b.npz")]
    rs = tmp_path / "walk" / "v9" / "rs" / "flow"
    rs.mkdir(parents=True)
    np.savez(rs / "x.npz", v=np.array(2.0))
    assert [tuple(r) for r in files.npz_features(files.artifact_walk(spark, str(tmp_path / "walk"))).collect()] == [("v9", "flow", "v", 2.0)]


def test_learning(spark):
    assert learning.topo_order({"a": ["b"], "b": [], "c": ["a"]}, ["a"]) == ["b", "a"]
    with pytest.raises(ValueError, match="cycle"):
        learning.topo_order({"a": ["b"], "b": ["a"]})
    df = frame(spark, [(i, float(i % 7), float((i * 37) % 11), 3.0 * (i % 7)) for i in range(120)], "id long, x double, z double, y double").withColumn("on", F.lit(1))
    models = learning.fit_heads(df, ["x", "z"], {"y": "on"}, rounds=5)
    imp = {r.feature: r.importance for r in learning.permutation_importance(df, models["y"], ["x", "z"], "y", "id").collect()}
    assert imp["x"] > imp["z"]
    assert learning.select_by_fold(df.withColumn("fold", F.col("id") % 2), ["x", "z"], "y", "fold", 1).select("feature").distinct().collect()[0][0] == "x"


def test_stream_steps():
    rows = pd.DataFrame({"key": [1, 1, 1], "event_id": [3, 1, 2], "status": ["done", "claimed", "claimed"]})
    state, out = jobs.claim_step(None, rows)
    assert state == (3, "done") and out.status[0] == "done"
    state, out = jobs.cap_step(2)((1,), rows)
    assert state == (2,) and out.accepted.tolist() == [True, False, False]
