"""Order-dependent acceptance against a plain sequential run."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from framewell.operators import balancing as B

SCHEMA = "g string, o long, c string, v double, lang string, secs long"


def sample(count=400, seed=3):
    rng = random.Random(seed)
    return [(rng.choice(["x", "y", None]), i, rng.choice("abcdefgh"), rng.choice([None, float("nan"), rng.gauss(10, 2), rng.gauss(10, 2), rng.gauss(10, 2) * rng.choice([1, 1, 1, 5])]), rng.choice(["en", "en", "en", "de", None]), rng.choice([None, 5, 30, 60, 299, 300, 4000])) for i in range(count)]


def bucket(v, bounds):
    if v is None:
        return "unknown"
    for i, (low, high) in enumerate(bounds, 1):
        if (low is None or v >= low) and (high is None or v <= high):
            return f"{i:02d} {'min' if low is None else low}-{'max' if high is None else high}"
    return "out_of_range"


def sequential(rows, cap, history, least, z, fields, mode, need, seed):
    """fields: name -> (place, coefficient, bounds, targets, unknown share, largest share). All rows of a group are kept in lists."""
    out = {}
    for g in {r[0] for r in rows}:
        draw, accepted, values = random.Random(seed), [], []
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            reason = score = None
            v = r[3] if r[3] is not None and r[3] == r[3] else None
            last = values[-history:]
            if v is not None and len(last) >= least and statistics.stdev(last) > 0 and (v - statistics.fmean(last)) / statistics.stdev(last) > z:
                reason = "outlier"
            elif sum(a[2] == r[2] for a in accepted) >= cap:
                reason = "channel_cap"
            elif fields:
                label = lambda row, f: bucket(row[fields[f][0]], fields[f][2]) if fields[f][2] else str(row[fields[f][0]] if row[fields[f][0]] is not None else "unknown")
                lost, weight, worst = 0, 0, {}
                for f, (_, k, bounds, targets, unknown, most) in fields.items():
                    own, before = label(r, f), [label(a, f) for a in accepted]
                    p = 0.0
                    if before:
                        share = before.count(own) / len(before)
                        names = [bucket(b[0] if b[0] is not None else b[1], [b]) for b in bounds or []]
                        names = [f"{i:02d}{n[2:]}" for i, n in enumerate(names, 1)]
                        if targets is None:
                            target = 1 / max(1, len({*names, *before}))
                        elif isinstance(targets, dict):
                            target = max(0.001, targets[own]) if own in targets else 1 / max(1, len({*names, *before}))
                        else:
                            target = max(0.001, targets[names.index(own)]) if own in names else 1 / max(1, len({*names, *before}))
                        then = (before.count(own) + 1) / (len(before) + 1)
                        if (own == "unknown" and unknown is not None and share >= unknown) or (most is not None and share >= most):
                            p = 1.0
                        elif then > target:
                            p = min(1.0, (then - target) / max(target, 0.001))
                    worst[f] = p
                    lost, weight = lost + k * p, weight + k
                score = round(max(0.0, 1 - lost / weight), 4)
                strict = min(1.0, weight / len(fields))
                if mode == "hard" or (mode == "mixed" and strict >= 0.75 and score < need):
                    ok = score >= need
                else:
                    ok = draw.random() <= (score if mode == "soft" else 1 - strict + strict * score)
                if not ok:
                    reason = "balancer_" + max(worst, key=worst.get)
            if reason is None:
                accepted.append(r)
                values += [v] if v is not None else []
            out[r[1]] = (score, reason)
    return out


FIELDS = {"lang": (4, 0.9, None, {"en": 0.5, "de": 0.4}, 0.1, 0.7), "secs": (5, 0.6, [(None, 59), (60, 300)], [0.3, 0.7], 0.2, None), "c": (2, 1.0, None, None, None, None)}


@pytest.mark.parametrize("mode", ["hard", "soft", "mixed", None])
@pytest.mark.parametrize("batch", [10_000, 7])
def test_accept_equals_a_sequential_run(spark, mode, batch):
    rows = sample()
    shares = {f: B.Share(k, tuple(b) if b else None, t, u, m) for f, (_, k, b, t, u, m) in FIELDS.items()}
    balance = B.Balance(shares, mode, 0.45, seed=9) if mode else None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {r.o: (getattr(r, "score", None), r.reason) for r in B.accept(spark.createDataFrame(rows, SCHEMA), "g", "o", "c", "v", 14, 40, 12, 1.8, balance).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sequential(rows, 14, 40, 12, 1.8, FIELDS if mode else {}, mode, 0.45, 9)
    assert len({reason for _, reason in got.values()}) >= (3 if mode is None else 4)


def test_known_cases(spark):
    """The second row of a full bucket goes; unknowns beyond their share go; coefficient 0 is no field."""
    rows = spark.createDataFrame([("g", 1, "a", 1.0, None, 30), ("g", 2, "b", 1.0, None, 35)], SCHEMA)
    run = lambda shares: [r.reason for r in B.accept(rows, "g", "o", "c", "v", 9, balance=B.Balance(shares, "hard")).orderBy("o").collect()]
    assert run({"secs": B.Share(1.0, ((0, 59), (60, 300)))}) == [None, "balancer_secs"]
    assert run({"lang": B.Share(1.0, unknown_share=0.1)}) == [None, "balancer_lang"]
    assert run({"secs": B.Share(0.0, ((0, 59), (60, 300)))}) == [None, None]


def test_registered_balance_equals_a_sequential_run(spark):
    from framewell.plans.ruling import t08_balanced_accept

    sf = "/root/testdata/sf0.001"
    rows = [(r.user_id, r.event_id, r.event_type, r.value, r.event_type, r.value) for r in spark.read.parquet(f"{sf}/events.parquet").where("user_id IS NOT NULL").collect()]
    fields = {"event_type": (4, 1.0, None, None, None, 0.5), "value": (5, 0.8, [(None, 9), (10, 49), (50, None)], [0.5, 0.3, 0.2], 0.1, None)}
    whole = [(*r[:5], None if r[5] is None else int(r[5])) for r in rows]
    assert {r.event_id: (r.score, r.reason) for r in t08_balanced_accept(spark, sf).collect()} == sequential(whole, 12, 500, 20, 3.0, fields, "hard", 0.6, 0)


def test_registered_acceptance_equals_a_sequential_run(spark):
    """t08_accept: event types as groups, users as channels."""
    from collections import Counter

    from framewell.plans.ruling import t08_accept

    sf = "/root/testdata/sf0.001"
    rows = [(r.event_type, r.event_id, r.user_id, r.value, None, None) for r in spark.read.parquet(f"{sf}/events.parquet").where("user_id IS NOT NULL AND value IS NOT NULL").collect()]
    want = Counter(reason for _, reason in sequential(rows, 8, 500, 20, 1.5, {}, None, 0, 0).values())
    assert {r.reason: r.n for r in t08_accept(spark, sf).collect()} == want
