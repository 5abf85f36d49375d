"""Greedy folds from the histogram of sizes against a plain greedy run."""

import random
from collections import Counter

import pytest

from framewell.operators import ranks


def greedy(sizes, folds):
    load, out = [0] * folds, []
    for s in sizes:
        f = load.index(min(load))
        load[f] += s
        out.append(f)
    return out


@pytest.mark.parametrize("seed", range(80))
def test_stretches_equal_plain_greedy(seed):
    rng = random.Random(seed)
    folds = rng.randrange(1, 8)
    sizes = sorted((rng.choice([1, 1, 2, 3, 7, rng.randrange(1, 200), 5000 if seed % 4 == 0 else 4]) for _ in range(rng.randrange(0, 150))), reverse=True)
    plan = ranks.lightest_folds(sorted(Counter(sizes).items(), reverse=True), folds)
    got = []
    for size, n in sorted(Counter(sizes).items(), reverse=True):
        own = {i: turn[(i - first) % len(turn)] for s, first, end, turn in plan if s == size for i in range(first, end)}
        got += [own[i] for i in range(n)]
    assert got == greedy(sizes, folds)
    assert len(plan) <= folds * len(set(sizes))


def test_one_giant_group_and_very_many_small_ones():
    """A gap of a billion rows is filled in a few stretches."""
    plan = ranks.lightest_folds([(10**9, 1), (1, 3 * 10**9)], 3)
    assert plan == [(10**9, 0, 1, [0]), (1, 0, 1, [1]), (1, 1, 2 * 10**9, [2, 1]), (1, 2 * 10**9, 3 * 10**9, [0, 1, 2])]


def test_folds_of_rows(spark):
    rows = [(k, i) for k, n in ((None, 3), ("a", 7), ("b", 3), ("c", 3), ("d", 1)) for i in range(n)]
    got = {r.g: r.fold for r in ranks.grouped_folds(spark.createDataFrame(rows, "g string, i int"), "g", 2).collect()}
    assert got == {"a": 0, None: 1, "b": 1, "c": 1, "d": 0}
    assert ranks.grouped_folds(spark.createDataFrame(rows, "g string, i int"), "g", 2).count() == len(rows)
    assert ranks.grouped_folds(spark.createDataFrame([], "g string, i int"), "g", 2).count() == 0
