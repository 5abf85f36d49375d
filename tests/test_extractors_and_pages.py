"""Batch extractors from SQL; pages of discovery through failures and restarts."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewell.functions import extractors as X
from framewell.sources import pages as P
from framewell.streaming import jobs as J


class Careful(X.BatchExtractor):
    """Fails on one text; tells how often its worker has set it up."""

    name = "careful"
    ups = 0

    def set_up(self):
        Careful.ups += 1

    def extract(self, value):
        if value == "bad":
            raise ValueError("a bad text")
        return {"length": len(value), "ups": Careful.ups, "worker": os.getpid()} if value != "none" else {}


def test_a_bad_row_costs_no_other_and_set_up_is_once_a_worker(spark):
    name = X.register_extractor(spark, Careful())
    rows = [(i, "bad" if i == 7 else None if i == 8 else "none" if i == 9 else "x" * i) for i in range(40)]
    spark.createDataFrame(rows, "id long, t string").repartition(3).createOrReplaceTempView("careful_rows")
    got = spark.sql(f"SELECT * FROM {name}(TABLE(SELECT id, t FROM careful_rows))").collect()
    assert {int(r.key): r.value for r in got if r.feature == "length"} == {i: float(i) for i in range(40) if i not in (7, 8, 9)}
    assert [(r.key, r.error, r.feature) for r in got if r.error] == [("7", "ValueError: a bad text", None)]
    assert {r.value for r in got if r.feature == "ups"} == {1.0} and not Careful().supports_batch and X.TextShape().supports_batch


def test_batches_equal_single_rows(spark):
    texts = ["", "One 2 three", "ÄÖ 漢字\tx", "A" * 50 + " 12345", "   "]
    name = X.register_extractor(spark, X.TextShape())
    spark.createDataFrame(list(enumerate(texts)), "id long, t string").createOrReplaceTempView("shape_rows")
    got = {(int(r.key), r.feature): r.value for r in spark.sql(f"SELECT * FROM {name}(TABLE(SELECT id, t FROM shape_rows))").collect()}
    want = {(i, k): v for i, t in enumerate(texts) for k, v in X.TextShape().extract(t).items() if not math.isnan(v)}
    assert got == want and got[1, "words"] == 3 and got[1, "digits"] == pytest.approx(1 / 11) and (0, "digits") not in got


def test_segments_from_a_lateral_join(spark):
    rng = np.random.default_rng(1)
    signals = [(i, rng.normal(size=n).tolist()) for i, n in enumerate([0, 1, 5, 17])]
    name = X.register_extractor(spark, X.SignalShape())
    spark.createDataFrame(signals, "id long, v array<double>").createOrReplaceTempView("signal_rows")
    made = "SELECT id, s.col AS segment, slice(v, s.col * 4 + 1, 4) AS piece, 8.0D AS rate FROM signal_rows, LATERAL explode(sequence(0, 4)) s"
    got = {(int(r.key), r.segment, r.feature): r.value for r in spark.sql(f"SELECT * FROM {name}(TABLE({made}))").collect()}
    want = {}
    for i, v in signals:
        for s in range(5):
            x = np.array(v[4 * s : 4 * s + 4])
            if len(x):
                want |= {(i, s, "rms"): math.sqrt((x**2).mean()), (i, s, "peak"): abs(x).max(), (i, s, "crossings"): sum((a < 0) != (b < 0) for a, b in zip(x, x[1:])) * 8 / len(x)}
    assert set(got) == set(want) and all(got[k] == pytest.approx(v) for k, v in want.items())


SCHEMA = "id long, v string"


def rows(spark, a, b):
    return spark.range(a, b).select("id", F.concat(F.lit("v"), "id").alias("v"))


def test_a_failed_batch_and_a_restart_neither_skip_nor_repeat_a_page(spark, tmp_path):
    path, out, calls = f"file://{tmp_path}/pages", f"{tmp_path}/out", []

    def fail_once(batch):
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("stopped")

    P.write_pages(rows(spark, 0, 25), ["id"], 10, path)
    assert J.run_confirmed(P.page_stream(spark, path, SCHEMA), out, fail_once).count() == 25
    P.write_pages(rows(spark, 25, 60), ["id"], 10, path, 3)
    with pytest.raises(Exception, match="stopped"):
        J.run_confirmed(P.page_stream(spark, path, SCHEMA), out, fail_once)
    # More pages come between; the failed batch keeps its own range, and they are the next one's.
    P.write_pages(rows(spark, 60, 70), ["id"], 10, path, 7)
    assert sorted(r.id for r in J.run_confirmed(P.page_stream(spark, path, SCHEMA), out, fail_once).collect()) == list(range(60))
    got = J.run_confirmed(P.page_stream(spark, path, SCHEMA), out, fail_once).collect()
    assert sorted(r.id for r in got) == list(range(70)) and calls == [0, 1, 1, 2]
    assert {r.page for r in got if r.id < 25} == {0, 1, 2} and {r.page for r in got if r.id >= 60} == {7} and all(r.v == f"v{r.id}" for r in got)
    assert {r.page for r in got if r.batch == 1} == {3, 4, 5, 6}
    assert J.run_confirmed(P.page_stream(spark, path, SCHEMA), out, fail_once).count() == 70 and len(calls) == 4


def test_a_page_waits_for_those_before_it(spark, tmp_path):
    path, out = f"file://{tmp_path}/pages", f"{tmp_path}/out"
    P.write_pages(rows(spark, 0, 10), ["id"], 10, path)
    P.write_pages(rows(spark, 20, 30), ["id"], 10, path, 2)
    assert J.run_confirmed(P.page_stream(spark, path, SCHEMA), out).count() == 10
    P.write_pages(rows(spark, 10, 20), ["id"], 10, path, 1)
    assert sorted(r.id for r in J.run_confirmed(P.page_stream(spark, path, SCHEMA), out).collect()) == list(range(30))
