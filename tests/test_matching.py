"""Matching against exhaustive search; tracks where the cheapest pair first would be wrong."""

import itertools

import numpy as np
import pytest

from framewell.operators import tracking
from framewell.operators.matching import cheapest_matching


def exhaustive(cost, allowed):
    """Most pairs, then least cost, over all ways to give each row a column or none."""
    n, m = cost.shape
    best = (0, 0.0)
    for columns in itertools.product(range(-1, m), repeat=n):
        used = [c for c in columns if c >= 0]
        if len(used) == len(set(used)) and all(allowed[i, c] for i, c in enumerate(columns) if c >= 0):
            best = min(best, (-len(used), sum(cost[i, c] for i, c in enumerate(columns) if c >= 0)))
    return best


@pytest.mark.parametrize("seed", range(60))
def test_total_cost_equals_exhaustive_search(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 6, 2)
    cost = rng.random((n, m)) if seed % 3 else rng.integers(0, 3, (n, m)).astype(float)
    allowed = rng.random((n, m)) < rng.choice([0.3, 0.7, 1.0])
    rows, cols = cheapest_matching(cost, allowed)
    assert len(set(rows.tolist())) == len(rows) and len(set(cols.tolist())) == len(cols) and allowed[rows, cols].all()
    size, total = exhaustive(cost, allowed)
    assert len(rows) == -size and cost[rows, cols].sum() == pytest.approx(total)


def test_empty_and_large_matchings():
    assert [len(x) for x in cheapest_matching(np.zeros((0, 3)), np.zeros((0, 3), bool))] == [0, 0]
    rng = np.random.default_rng(1)
    cost = rng.random((80, 70))
    rows, cols = cheapest_matching(cost, np.ones_like(cost, bool))
    # No exchange of two partners is cheaper.
    assert len(rows) == 70
    swap = cost[rows[:, None], cols[None]] + cost[rows[None], cols[:, None]]
    own = cost[rows, cols]
    assert (swap >= own[:, None] + own[None] - 1e-9).all()


def detections(*frames):
    return [("v", f, s, list(map(float, look)), float(x), 0.0) for f, own in enumerate(frames) for s, (look, x) in enumerate(own)]


def tracks(spark, rows):
    df = spark.createDataFrame(rows, "video string, frame int, slot int, v array<double>, x double, y double")
    return {(r.frame, r.slot): r.track for r in tracking.assign_tracks(df, "video", "frame", "slot", "v", "x", "y").collect()}


def test_matching_is_optimal_where_the_cheapest_pair_first_is_not(spark):
    """The nearest pair is track 1 with detection 0; taking it leaves track 0 with nothing in reach."""
    look = [1, 0]
    first = [(look, 0.0), (look, 0.5)]
    second = [(look, 0.45), (look, 0.95)]
    assert tracks(spark, detections(first, second)) == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1}


def test_lost_tracks_come_back_by_look_and_old_ones_do_not(spark):
    a, b = [1, 0, 0], [0, 1, 0]
    other = [([0, 0, 1], 0.0)]
    quiet = [other] * 6
    got = tracks(spark, detections([(a, 0.1), *other], *quiet, [(a, 0.9)], [(b, 0.9)]))
    assert got[(7, 0)] == got[(0, 0)] and got[(8, 0)] not in (got[(0, 0)], got[(0, 1)])
    gone = tracks(spark, detections([(a, 0.1), *other], *[other] * 14, [(a, 0.1)]))
    assert gone[(15, 0)] != gone[(0, 0)]
