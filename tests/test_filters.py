"""Smoothing and peaks against numpy."""

import math
import random

import numpy as np
import pytest

from framewell.operators import filters as C

SCHEMA = "k string, t double, v double, u double, _i int"


def curves(seed=0):
    rng = random.Random(seed)
    sizes = {"one": 1, "two": 2, "three": 3, "five": 5, "six": 6, "nine": 9, "long": 60, "flat": 12}
    return {k: [(k, float(i), 1.0 if k == "flat" else float(rng.choice([rng.gauss(0, 3), rng.randrange(3)])), rng.random(), 7) for i in range(n)] for k, n in sizes.items()}


def frame(spark, own):
    rows = [r for c in own.values() for r in c]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([*rows, ("one", 9.0, None, None, 7)], SCHEMA)


def mirrored(x, w):
    reach, n = len(w) // 2, len(x)
    out = []
    for i in range(n):
        total = 0.0
        for j, y in enumerate(w):
            p = i + j - reach
            while not 0 <= p < n:
                p = -p - 1 if p < 0 else 2 * n - 1 - p
            total += y * x[p]
        out.append(total)
    return np.array(out)


@pytest.mark.parametrize("sigma", [0.0, 0.5, 1.0, 3.0])
def test_gaussian_mirrors_the_edges(spark, sigma):
    own = curves()
    reach = int(4 * sigma + 0.5)
    w = np.array([math.exp(-0.5 * (j / sigma) ** 2) if sigma else 1.0 for j in range(-reach, reach + 1)])
    got = {(r.k, r.t): r.s for r in C.gaussian(frame(spark, own), ["k"], "t", "v", sigma, "s").collect()}
    for k, rows in own.items():
        assert [got[k, r[1]] for r in rows] == pytest.approx(mirrored([r[2] for r in rows], w / w.sum()).tolist())


@pytest.mark.parametrize(("window", "degree"), [(5, 2), (6, 2), (7, 3), (9, 1)])
def test_savgol_equals_polynomial_fits(spark, window, degree):
    own = curves()
    got = {(r.k, r.t): r.s for r in C.savgol(frame(spark, own), ["k"], "t", "v", window, degree, "s").collect()}
    size = window if window % 2 else window - 1
    for k, rows in own.items():
        x, n = np.array([r[2] for r in rows]), len(rows)
        want = x.copy()
        if n > window:
            for i in range(n):
                a = min(max(i - size // 2, 0), n - size)
                want[i] = np.polyval(np.polyfit(np.arange(size), x[a : a + size], degree), i - a)
        assert [got[k, r[1]] for r in rows] == pytest.approx(want.tolist())


def standard(x):
    return (x - x.mean()) / (x.std() + 1e-6)


def story(rows, sigma):
    reach = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    w /= w.sum()
    a, b = (standard(mirrored([r[c] for r in rows], w)) for c in (2, 3))
    return standard(mirrored(0.5 * a + 0.5 * b, w))


def test_energy_and_its_peaks_equal_numpy(spark):
    own = {k: v for k, v in curves(4).items() if k != "flat"}
    df = C.energy(frame(spark, own), ["k"], "t", "v", "u", 1.0, "energy")
    got = {(r.k, r.t): r.energy for r in df.collect()}
    peaks = {(r.k, r.t) for r in C.high_peaks(df, ["k"], "t", "energy", 6.0, 0.8).collect()}
    want = set()
    for k, rows in own.items():
        e = story(rows, 1.0)
        assert [got[k, r[1]] for r in rows] == pytest.approx(e.tolist(), abs=1e-6)
        high = [i for i in range(1, len(e) - 1) if len(e) >= 4 and e[i] > e[i - 1] and e[i] > e[i + 1] and e[i] >= np.percentile(e, 80)]
        kept = []
        for i in sorted(high, key=lambda i: -e[i]):
            if all(abs(i - j) >= 6 for j in kept):
                kept.append(i)
        want |= {(k, rows[i][1]) for i in kept}
    assert len(want) > 2 and peaks == want


def test_plateaus_count_once_in_their_middle(spark):
    values = [0, 2, 2, 2, 1, 3, 3, 0, 0, 5, 5, 6, 6]
    df = spark.createDataFrame([("a", float(i), float(v), 0.0, 0) for i, v in enumerate(values)] + [("b", 0.0, 1.0, 0.0, 0)], SCHEMA)
    assert sorted((r.k, r.t) for r in C.maxima(df, ["k"], "t", "v").collect()) == [("a", 2.0), ("a", 5.0)]


def jumps(x, least, distance, k):
    c = np.array([np.nan if v is None else v for v in x], float)
    if len(c) < 3:
        return []
    c[0] = c[-1] = np.nan
    with np.errstate(invalid="ignore"):
        at = [i for i in range(1, len(c) - 1) if c[i] >= least and c[i] >= c[i - 1] and c[i] > c[i + 1]]
    kept = []
    for i in sorted(at, key=lambda i: (-c[i], -i)):
        if len(kept) < k and all(abs(i - j) >= distance for j in kept):
            kept.append(i)
    return kept


@pytest.mark.parametrize(("least", "distance", "k"), [(-9.0, 1, 3), (0.5, 4, 2), (-9.0, 7, 50), (0.0, 0, 2), (99.0, 2, 2)])
def test_top_jumps_keep_their_distance(spark, least, distance, k):
    own = curves(7)
    own["long"] = [(*r[:2], None if i % 17 == 5 else r[2], *r[3:]) for i, r in enumerate(own["long"])]
    own.pop("one")
    rows = [r for c in own.values() for r in c]
    got = {}
    for r in C.top_jumps(spark.createDataFrame(rows, SCHEMA), ["k"], "t", "v", least, distance, k).collect():
        got.setdefault(r.k, []).append((r["rank"], r.place))
    for key, c in own.items():
        assert [p for _, p in sorted(got.get(key, []))] == jumps([r[2] for r in c], least, distance, k)
