"""Confirmed flushes over restarts, leases, tracks, saved models and validators on small hand-made cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewell.functions import registered
from framewell.operators import learning, profile, rules, tracking, vectors
from framewell.sources import files
from framewell.streaming import jobs


def test_confirmed_sink_counts_each_batch_once_over_a_restart(spark, tmp_path):
    for i in range(4):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream, calls = lambda: jobs.file_stream(spark, str(tmp_path / "in"), "id long", 1), []

    def fail_once(batch):
        calls.append(batch)
        if len(calls) == 3:
            raise RuntimeError("upload failed")

    with pytest.raises(Exception, match="upload failed"):
        jobs.run_confirmed(stream(), str(tmp_path / "out"), fail_once)
    # The third batch's rows are written but not confirmed.
    assert jobs.confirmed(spark, str(tmp_path / "out"), "id long").count() == 20
    got = jobs.run_confirmed(stream(), str(tmp_path / "out"), fail_once)
    assert sorted(r.id for r in got.collect()) == list(range(40)) and calls == [0, 1, 2, 2, 3]
    assert jobs.run_confirmed(stream(), str(tmp_path / "out"), fail_once).count() == 40 and len(calls) == 5


def test_leases_follow_owner_and_time():
    step = jobs.lease_step(10.0)
    rows = pd.DataFrame([("k", 1, "a", "acquire", 0.0), ("k", 2, "b", "acquire", 5.0), ("k", 3, "a", "heartbeat", 8.0), ("k", 4, "b", "acquire", 17.0), ("k", 5, "b", "acquire", 18.0), ("k", 6, "a", "release", 19.0), ("k", 7, "b", "release", 20.0), ("k", 8, "a", "heartbeat", 21.0), ("k", 9, "a", "acquire", 22.0)], columns=["key", "event_id", "owner", "action", "at"])
    state, out = step(None, rows.sample(frac=1, random_state=1))
    assert out.granted.tolist() == [True, False, True, False, True, False, True, False, True] and state == ("a", 32.0)
    half, first = step(None, rows[:4])
    assert step(half, rows[4:])[1].granted.tolist() == out.granted.tolist()[4:] and first.granted.tolist() == out.granted.tolist()[:4]


def test_tracks_follow_looks_gates_and_revival(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    rows = [(1, 0, 0, a, 0.1, 0.1), (1, 0, 1, b, 0.8, 0.8), (1, 1, 0, b, 0.75, 0.8), (1, 1, 1, a, 0.15, 0.1), (1, 2, 0, a, 0.9, 0.1)]
    rows += [(1, f, 0, b, 0.8, 0.8) for f in range(3, 8)] + [(1, 8, 0, a, 0.2, 0.9), (1, 9, 0, None, 0.1, 0.1), (2, 0, 0, a, 0.5, 0.5)]
    df = spark.createDataFrame(rows, "video int, frame int, slot int, v array<double>, x double, y double")
    got = {(r.video, r.frame, r.slot): r.track for r in tracking.assign_tracks(df, "video", "frame", "slot", "v", "x", "y").collect()}
    assert got[1, 0, 0] == got[1, 1, 1] == 0 and got[1, 0, 1] == got[1, 1, 0] == 1
    assert got[1, 2, 0] == 2  # moved too far to be the first
    assert {got[1, f, 0] for f in range(3, 8)} == {1} and got[1, 8, 0] in (0, 2) and (1, 9, 0) not in got and got[2, 0, 0] == 0
    assert tracking.assign_tracks(df.limit(0), "video", "frame", "slot", "v", "x", "y").collect() == []


def test_saved_models_score_alike(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i % 7), 2.0 * i, 1) for i in range(200)], "a double, b double, y double, m int")
    models = learning.fit_heads(df, ["a", "b"], {"y": "m"}, rounds=3, depth=3)
    learning.save_models(models, str(tmp_path / "bundle"))
    loaded = learning.load_models(str(tmp_path / "bundle"), ["y"])
    key = lambda out: sorted((r.a, r.pred_y) for r in out.collect())
    assert key(learning.predict(df, models)) == key(learning.predict(df, loaded))
    rise = {r.feature: r.importance for r in learning.permutation_importance(df, models["y"], ["a", "b"], "y", "a").collect()}
    assert rise["a"] > 10 * abs(rise["b"])


def test_validators_name_each_issue(spark):
    df = spark.createDataFrame([(1, 0.5, 3.0), (2, 1.5, float("nan")), (3, None, -1.0), (4, float("inf"), None)], "k int, a double, b double")
    out = rules.validate(df, ["k"], [("a", 0.0, 1.0, "error"), ("b", 0.0, 10.0, "warning")], [("a_over_b", "info", F.col("a") > F.col("b"))])
    assert sorted((r.k, r.feature, r.severity) for r in out.collect()) == [(2, "a", "error"), (2, "b", "warning"), (3, "b", "warning"), (4, "a", "error")]


def test_emotion_summary_is_a_mean_of_shares(spark):
    rows = [(1, 0.5, 0.4, {"Happy": 1.0}, 1.0), (1, -0.5, 0.6, {"Fear": 0.5, "Anger": 0.5}, 1.0), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "k int, valence double, arousal double, chances map<string, double>, rate double")
    got = {r.k: r for r in profile.emotion_summary(df, ["k"]).collect()}
    var = (np.var([0.5, -0.5]) + np.var([0.4, 0.6])) / 2
    assert got[1].stress == pytest.approx((0.5 + 0.5 + min(1, 2 * var)) / 3) and got[1].confidence == pytest.approx((0.5 + 0.5 + 0.5 + 1 - var) / 4)
    assert got[1].tension == pytest.approx((0.5 + 1 - 2 * var + 0.5) / 3) and got[1].nervousness == pytest.approx((3 * var + 0.5 + 0.25) / 3)
    with_micro = {r.k: r for r in profile.emotion_summary(df, ["k"], micro="rate").collect()}
    assert with_micro[1].stress == pytest.approx((0.5 + 0.5 + 2 * var + 0.5) / 4) and got[2].confidence == pytest.approx((0 + 1 + 0 + 1) / 4)


def test_mean_similarity_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 3, i, rng.normal(size=4).tolist()) for i in range(40)] + [(9, 100, [1.0, 0.0, 0.0, 0.0]), (9, 101, [0.0, 0.0, 0.0, 0.0])]
    got = {r.i: r.mean_similarity for r in vectors.mean_similarity(spark.createDataFrame(rows, "g int, i int, v array<double>"), ["g"], "i", "v").collect()}
    for g, i, v in rows[:40]:
        own = [np.dot(v, u) / np.linalg.norm(v) / np.linalg.norm(u) for h, j, u in rows[:40] if h == g and j != i]
        assert got[i] == pytest.approx(np.mean(own))
    assert got[100] is None and 101 not in got


def test_inner_product_keeps_lengths(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [5.0, 0.0]), (2, [0.0, 9.0])], "i long, v array<double>")
    out = vectors.top_k_cosine_all(df.where("i = 0").toDF("q", "v"), df, "q", "i", "v", 2, False, False).collect()
    assert [(r["rank"], r.i, r.score) for r in sorted(out, key=lambda r: r["rank"])] == [(1, 1, 5.0), (2, 0, 1.0)]


def test_required_columns_and_tables_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "a int, b array<int>")
    with pytest.raises(ValueError, match="c"):
        files.require_columns(df, ["a", "c"])
    files.write_table(df, str(tmp_path / "t.csv"))
    assert files.read_dataset(spark, str(tmp_path / "t.csv")).collect()[0].b == "[1,2]"
    with pytest.raises(ValueError, match="no writer"):
        files.write_table(df, str(tmp_path / "t.xls"))


def test_extractors_run_after_what_they_need(spark):
    made = []

    def extractor(name, *requires):
        class One:
            def extract(self, df):
                made.append(name)
                return df.select("k", F.lit("n").alias("feature"), F.lit(1.0).alias("value"))

        One.name, One.requires = name, requires
        return One()

    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert registered.run_extractors(df, [extractor("b", "a"), extractor("a")], "k").count() == 4 and made == ["a", "b"]
    with pytest.raises(KeyError):
        registered.run_extractors(df, [extractor("b", "missing")], "k")


def test_registered_functions_in_sql(spark):
    registered.register(spark)
    rows = spark.sql("SELECT place, word FROM framewell_words('one two')").collect()
    assert [(r.place, r.word) for r in rows] == [(0, "one"), (1, "two")]
    assert 0 <= spark.sql("SELECT framewell_unit_hash('x') AS u").first().u < 1


def test_late_rows_are_dropped_and_old_windows_leave(spark, tmp_path):
    """Files in order: two hours of rows, rows ten hours later, then one that is late; a one-hour watermark, known to the batch after the next."""
    import time

    for i, rows in enumerate(([(0.1, 1.0), (0.5, 2.0), (1.2, 4.0)], [(11.0, 8.0)], [(11.1, 1.0)], [(0.2, 100.0), (11.5, 16.0)], [(30.0, 32.0)], [(31.0, 0.0)])):
        df = spark.createDataFrame(rows, "h double, value double").select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("h") * 3600).alias("ts"), "value")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are taken by age
    stream = jobs.file_stream(spark, str(tmp_path / "in"), "k string, ts timestamp, value double", 1)
    got = sorted((r.start.hour, r.n, r.total) for r in jobs.run_to_end(jobs.tumbling(stream, ["k"], "ts", "1 hour", "1 hour")).collect())
    assert got == [(0, 2, 3.0), (1, 1, 4.0), (11, 3, 25.0)]
