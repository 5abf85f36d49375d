"""Principal components and projected centroids against numpy."""

import numpy as np
import pytest

from framewell.operators import projection as P


def data(n=300, d=9, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 50 * rng.normal(size=d)
    return x, rng.integers(0, 5, n)


def table(spark, x, label):
    rows = [(i, v.tolist(), int(c), "kept") for i, (v, c) in enumerate(zip(x, label))]
    odd = [(9000, None, 1, "kept"), (9001, [1.0], 1, "kept"), (9002, [float("nan")] * x.shape[1], 2, "kept")]
    return spark.createDataFrame(rows + odd, "id long, v array<double>, c int, _ready string").repartition(7)


def test_components_equal_numpy(spark):
    x, label = data()
    got = P.fit_projection(table(spark, x, label), "v", 4)
    variance, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    axes = axes[:, ::-1][:, :4]
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), range(4)])
    assert got.mean == pytest.approx(x.mean(axis=0)) and got.variances == pytest.approx(variance[::-1][:4])
    assert got.components == pytest.approx(axes, abs=1e-8)
    rows = {r.id: (r.p, r["_ready"], r.c) for r in P.project(table(spark, x, label), "v", got, "p").collect()}
    want = (x - x.mean(axis=0)) @ axes
    assert all(rows[i][0] == pytest.approx(want[i].tolist(), abs=1e-8) and rows[i][1:] == ("kept", label[i]) for i in range(len(x)))
    assert [rows[i][0] for i in (9000, 9001, 9002)] == [None] * 3


@pytest.mark.parametrize("centred", [True, False])
def test_projected_centroids_and_margins_equal_numpy(spark, centred):
    x, label = data(seed=6)
    by = P.fit_projection(table(spark, x, label), "v", 3)
    means = np.stack([x[label == c].mean(axis=0) for c in range(5)])
    centroids = spark.createDataFrame([(c, m.tolist()) for c, m in enumerate(means)], "c int, v array<double>")
    got = {r.id: (r.cluster, r.distance, r.margin) for r in P.nearest_projected(table(spark, x, label), centroids, "id", "c", "v", by, centred).collect()}
    a, b = ((y - (x.mean(axis=0) if centred else 0)) @ by.components for y in (x, means))
    cos = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    top = np.sort(cos, axis=1)[:, ::-1]
    assert set(got) == set(range(len(x)))
    for i in range(len(x)):
        assert got[i] == (cos[i].argmax(), pytest.approx(1 - top[i, 0], abs=1e-9), pytest.approx(top[i, 0] - top[i, 1], abs=1e-9))


def test_one_centroid_and_tables_without_vectors(spark):
    x, label = data(20)
    by = P.fit_projection(table(spark, x, label), "v", 2)
    one = spark.createDataFrame([(4, x[0].tolist())], "c int, v array<double>")
    assert {r.cluster for r in P.nearest_projected(table(spark, x, label), one, "id", "c", "v", by).collect()} == {4}
    with pytest.raises(ValueError):
        P.fit_projection(table(spark, x, label).where("id >= 9000 AND v IS NULL"), "v", 2)
