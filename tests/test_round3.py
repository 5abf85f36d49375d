"""Large keys, ties and steps that a single task or one whole frame used to hold."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from framewell import catalog
from framewell.operators import joins, learning, ranks, vectors
from framewell.sources import bigjson
from framewell.streaming import machines


def test_nearest_match_of_one_large_key(spark):
    """No frame ends with its partition, and looks cross partitions; equal points, repeated probes, a missing x."""
    rng = np.random.default_rng(3)
    at, ask = rng.integers(0, 9000, 3000) / 2, rng.integers(-200, 20_000, 2000) / 4
    points = spark.createDataFrame([(1, float(x), i) for i, x in enumerate(at)] + [(1, None, -1), (2, 5.0, 7)], "g int, x double, p int")
    probes = spark.createDataFrame([(1, float(x)) for x in ask] + [(3, 1.0)], "g int, x double")
    out = joins.nearest_match(probes, points, ["g"], "x", "p")
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    want = sorted((1, float(x), int(np.lexsort((np.arange(len(at)), abs(at - x)))[0])) for x in ask)
    got = [tuple(r) for r in out.collect()]
    assert sorted(r for r in got if r[0] == 1) == want and [r for r in got if r[0] == 3] == [(3, 1.0, None)] and len(got) == 2001


def test_equal_line_numbers_keep_the_first_row(spark, tmp_path):
    """In the order of the table, whatever tasks read it."""
    rng = np.random.default_rng(4)
    n = 4000
    t = {"l_orderkey": rng.integers(0, 50, n), "l_suppkey": rng.integers(0, 4, n), "l_linenumber": rng.integers(1, 4, n).astype("int32"), "l_quantity": rng.permutation(n).astype("float64")}
    (tmp_path / "lineitem.parquet").mkdir()
    pq.write_table(pa.table(t)[:300], tmp_path / "lineitem.parquet" / "part-0.parquet", row_group_size=100)
    pq.write_table(pa.table(t)[300:], tmp_path / "lineitem.parquet" / "part-1.parquet", row_group_size=200)
    want = {}
    for o, s, line, q in sorted(zip(*(t[c].tolist() for c in t)), key=lambda r: r[:3]):
        want.setdefault((o, s), (line, q))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = catalog.queries()["t18_idempotent"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {(r.l_orderkey, r.l_suppkey): (r.l_linenumber, r.l_quantity) for r in got} == want and len(got) == len(want)


def test_consumer_groups_have_small_shards(spark, monkeypatch):
    """However many messages there are, a shard keeps its size; results do not depend on it."""
    name, sf = "t13_consumer_group", "/root/testdata/sf0.001"
    want = sorted(map(tuple, catalog.queries()[name](spark, sf).collect()))
    monkeypatch.setattr(machines, "SHARD_MESSAGES", 10)
    given, group = [], machines.consumer_group
    monkeypatch.setattr(machines, "consumer_group", lambda *args, **named: given.append(named["shards"]) or group(*args, **named))
    assert sorted(map(tuple, catalog.queries()[name](spark, sf).collect())) == want
    assert given == [len(want) // 10]


def _spearman(a, b):
    rank = lambda v: np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
    return np.corrcoef(rank(a), rank(b))[0, 1]


def _numbers(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 6, 300).astype(float), rng.integers(0, 40, 300).astype(float)
    c = np.where(rng.random(300) < 0.2, np.nan, a * 3 + rng.integers(0, 9, 300))
    fold = rng.integers(0, 3, 300)
    rows = [(int(f), *map(float, x)) for f, *x in zip(fold, a, b, c, a + b + np.nan_to_num(c))]
    return spark.createDataFrame(rows, "fold int, a double, b double, c double, y double"), fold, {"a": a, "b": b, "c": c}, a + b + np.nan_to_num(c)


def test_ranks_are_taken_from_the_first_rows(spark):
    """Pairs with gaps filled by the median, without a join of rows for each rank; short tables of ranks are broadcast."""
    df, _, x, _ = _numbers(spark)
    x["c"] = np.where(np.isnan(x["c"]), np.nanmedian(x["c"]), x["c"])
    out = ranks.redundant_pairs(df, "fold", ["a", "b", "c"], 0.0)
    want = {(i, j): _spearman(x[i], x[j]) for i, j in (("a", "b"), ("a", "c"), ("b", "c"))}
    got = {(r.feature_a, r.feature_b): r.spearman for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_folds_do_not_repeat_rows(spark):
    """Ranks of each fold's training rows, over rows where feature and target are finite."""
    df, fold, x, y = _numbers(spark)
    got = {(r.fold, r.feature): r.spearman for r in learning._fold_spearman(df, ["a", "b", "c"], "y", "fold", [0, 1, 2]).collect()}
    for k in range(3):
        for f, v in x.items():
            on = (fold != k) & ~np.isnan(v)
            assert abs(got[k, f] - _spearman(v[on], y[on])) < 1e-9
    best = {k: sorted((-round(abs(got[k, f]), 9), f) for f in x)[0][1] for k in range(3)}
    assert {r.fold: r.feature for r in learning.select_by_fold(df, ["a", "b", "c"], "y", "fold", 1).collect()} == best


def test_blocks_are_looked_at_in_slices():
    """A batch of 40 MB takes a few MB; escapes before quotes are told by their number."""
    import tracemalloc

    rng = np.random.default_rng(6)
    for _ in range(300):
        text = bytes(rng.choice(np.frombuffer(b'\\\\"{,x', np.uint8), 30))
        plain, inside, want = [], 0, []
        for i, c in enumerate(text):
            run = len(text[:i]) - len(text[:i].rstrip(b"\\"))
            if c == 34 and run % 2 == 0:
                plain.append(i)
                inside ^= 1
            elif c in b"{,":
                want.append((i, inside))
        at, odd, quotes = bigjson._marks(text)
        assert quotes.tolist() == plain and list(zip(at.tolist(), odd.tolist())) == want
    n = 4000
    batch = pa.record_batch({"value": pa.array(['"k":"' + "x\\\"" * 3400] * n), "path": pa.array(["a"] * n), "block": pa.array([0] * n), "size": pa.array([1] * n)})
    tracemalloc.start()
    list(bigjson._summaries(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_uniqueness_deals_blocks_by_key(spark, monkeypatch):
    """Small keys, one over the size of a block, vectors of two dimensions; calls follow the keys' rows, not the table's blocks."""
    monkeypatch.setattr(vectors, "QUERY_ROWS", 16)
    monkeypatch.setattr(vectors, "GALLERY_ROWS", 32)
    rng = np.random.default_rng(7)
    rows = [(k, i, [float(x) for x in rng.normal(size=3)]) for i, k in enumerate([0] * 50 + [1] * 5 + [2] * 7 + [3])] + [(1, 90, [1.0]), (2, 91, None), (2, 92, [0.0, 0.0, 0.0])]
    calls, met = [], vectors._met
    monkeypatch.setattr(vectors, "_met", lambda *args, **named: calls.append(named.get("size")) or met(*args, **named))
    df = spark.createDataFrame(rows, "k int, i int, v array<double>")
    got = {r.k: r for r in vectors.uniqueness(df, ["k"], "i", "v", 0.5).collect()}
    assert calls == ["_c"] and set(got) == {0, 1, 2}
    for k, n in ((0, 50), (1, 5), (2, 7)):
        v = np.array([x for key, _, x in rows if key == k and x and len(x) == 3 and any(x)])
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        s = v @ v.T
        np.fill_diagonal(s, -1)
        m = s.max(axis=1)
        assert got[k].n == n and abs(got[k].repetition_ratio - (m >= 0.5).mean()) < 1e-9 and abs(got[k].p95_similarity - np.quantile(m, 0.95)) < 1e-9


def test_full_blocks_take_little_memory():
    """Two full blocks of 64 dimensions, as a worker holds them."""
    import tracemalloc

    rng = np.random.default_rng(8)
    side = lambda n, i, v: pa.table({i: np.arange(n), v: pa.array(list(rng.normal(size=(n, 64)).astype("float32")))})
    q, g = side(vectors.QUERY_ROWS, "_q", "_qv"), side(vectors.GALLERY_ROWS, "_g", "_gv")
    tracemalloc.start()
    assert vectors._best_of_block(5, True, True, q, g).num_rows == 5 * vectors.QUERY_ROWS
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
