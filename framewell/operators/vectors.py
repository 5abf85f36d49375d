"""Vector operators (V01-V14, F27, W02, W24, A29-A38, A44, J15-J16 of the survey) over ARRAY<FLOAT or DOUBLE> columns."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from framewell.operators.ranks import top_k


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def doubles(v: Column | str) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def normalise(v: Column | str, policy: str = "leave", eps: float = 1e-9) -> Column:
    """Unit vector; a zero one by policy: "add" divides by norm + eps, "floor" by max(norm, eps), "leave" keeps it."""
    n = norm(v)
    by = {"add": n + eps, "floor": F.greatest(n, F.lit(eps)), "leave": F.when(n > 0, n).otherwise(F.lit(1.0))}[policy]
    # The norm stands beside the components: within the function over them it would be worked out for each one.
    return F.zip_with(doubles(v), F.array_repeat(by, F.size(_c(v))), lambda x, y: x / y)


def usable(v: Column | str) -> Column:
    return _c(v).isNotNull() & F.forall(doubles(v), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def cosine(a: Column | str, b: Column | str) -> Column:
    """NULL for differing dimensions, zero norms or non-finite components."""
    ok = usable(a) & usable(b) & (F.size(_c(a)) == F.size(_c(b)))
    n = norm(a) * norm(b)
    return F.when(ok, F.when(n > 0, dot(a, b) / n))


def cosine_flag(a: Column | str, b: Column | str) -> Column:
    """Why a cosine is NULL."""
    return F.when(_c(a).isNull() | _c(b).isNull(), "missing").when(F.size(_c(a)) != F.size(_c(b)), "dimension").when(~usable(a) | ~usable(b), "non_finite").when((norm(a) == 0) | (norm(b) == 0), "zero_norm").otherwise("ok")


def top_k_cosine(queries: DataFrame, gallery: DataFrame, qid: str, gid: str, vector: str, k: int, exclude_self: bool = False) -> DataFrame:
    """The k most similar gallery vectors of each query, ties to the smaller id (V06-V08, J15): qid, rank, gid, score."""
    return top_k_cosine_all(queries, gallery, qid, gid, vector, k, exclude_self)


#: Vectors of a block of queries and of the gallery; two blocks meet in a task, and a query keeps its best of each.
QUERY_ROWS, GALLERY_ROWS = 8_192, 16_384
#: Scores in a worker's memory at a time.
_SCORES = 1 << 20


def _matrix(t: pa.Table, name: str, unit: bool = True) -> np.ndarray:
    v = t[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(t.num_rows, -1)
    if unit:
        v /= np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return v


def _scores(q: pa.Table, g: pa.Table, exclude_self: bool, unit: bool = True):
    """First row and matrix of cosines (inner products unless unit) rounded to 12 digits, chunk by chunk; -inf where a row meets itself."""
    a, b = _matrix(q, "_qv", unit), _matrix(g, "_gv", unit).T
    own = pc.fill_null(pc.index_in(q["_q"], value_set=g["_g"].combine_chunks()), -1).to_numpy(zero_copy_only=False) if exclude_self else None
    step = max(1, _SCORES // g.num_rows)
    for lo in range(0, q.num_rows, step):
        s = a[lo : lo + step] @ b
        np.round(s, 12, out=s)
        if exclude_self:
            at = np.flatnonzero(own[lo : lo + step] >= 0)
            s[at, own[lo + at]] = -np.inf
        yield lo, s


def _best_of_block(k: int, exclude_self: bool, unit: bool, q: pa.Table, g: pa.Table) -> pa.Table:
    g = g.sort_by("_g")
    rows, cols, values = [np.empty(0, "int64")], [np.empty(0, "int64")], [np.empty(0)]
    for lo, s in _scores(q, g, exclude_self, unit) if q.num_rows and g.num_rows else ():
        if s.shape[1] > k:
            least = np.partition(s, s.shape[1] - k, axis=1)[:, -k, None]
            keep = s >= least
            tied = np.flatnonzero(keep.sum(axis=1) > k)  # the smaller ids of equal scores
            above, equal = s[tied] > least[tied], s[tied] == least[tied]
            keep[tied] = above | (equal & (equal.cumsum(axis=1) <= k - above.sum(axis=1, keepdims=True)))
        else:
            keep = np.ones(s.shape, bool)
        i, j = np.nonzero(keep & (s > -np.inf))
        rows.append(i + lo), cols.append(j), values.append(s[i, j])
    return pa.table({"_q": q["_q"].take(pa.array(np.concatenate(rows))), "_g": g["_g"].take(pa.array(np.concatenate(cols))), "score": np.concatenate(values)})


def _best_of_groups(exclude_self: bool, q: pa.Table, g: pa.Table) -> pa.Table:
    g = g.sort_by("_t")
    code = pc.rank(g["_t"], tiebreaker="dense").to_numpy() if g.num_rows else np.empty(0)
    first = np.flatnonzero(np.diff(code, prepend=-1))
    rows, cols, values = [np.empty(0, "int64")], [np.empty(0, "int64")], [np.empty(0)]
    for lo, s in _scores(q, g, exclude_self) if q.num_rows and g.num_rows else ():
        m = np.maximum.reduceat(s, first, axis=1)
        i, j = np.nonzero(m > -np.inf)
        rows.append(i + lo), cols.append(first[j]), values.append(m[i, j])
    return pa.table({"_q": q["_q"].take(pa.array(np.concatenate(rows))), "_t": g["_t"].take(pa.array(np.concatenate(cols))), "score": np.concatenate(values)})


def _met(queries: DataFrame, gallery: DataFrame, qid: str, gid: str, vector: str, *keep: Column, by: list[str] = (), size: str | None = None):
    """Both sides dealt in blocks, each block of one side sent to each block of the other, grouped by pair and dimension (and ``by``).

    With ``size``, a column that holds the number of rows of a row's own ``by``, blocks are those of each such key.
    """
    if size:
        n, m = (F.greatest(F.lit(1), F.ceil(F.col(size) / rows)).cast("int") for rows in (QUERY_ROWS, GALLERY_ROWS))
    else:
        n, m = (F.lit(max(1, -(-df.count() // rows))) for df, rows in ((queries, QUERY_ROWS), (gallery, GALLERY_ROWS)))

    def side(df: DataFrame, own: str, blocks: Column, other: str, others: Column, *columns: Column) -> DataFrame:
        key = qid if own == "_i" else gid
        rows = df.where(usable(vector) & (norm(vector) > 0)).select(*columns, *(F.col(k).alias(k) for k in by), F.size(vector).alias("_d"), F.pmod(F.xxhash64(key), blocks).cast("int").alias(own), (others - 1).alias("_last"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_last")))).drop("_last")

    q = side(queries, "_i", n, "_j", m, F.col(qid).alias("_q"), F.col(vector).alias("_qv"))
    g = side(gallery, "_j", m, "_i", n, F.col(gid).alias("_g"), F.col(vector).alias("_gv"), *keep)
    return q.groupBy(*by, "_d", "_i", "_j").cogroup(g.groupBy(*by, "_d", "_i", "_j"))


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def top_k_cosine_all(queries: DataFrame, gallery: DataFrame, qid: str, gid: str, vector: str, k: int, exclude_self: bool = False, unit: bool = True) -> DataFrame:
    """As top_k_cosine, for many queries against many vectors: blocks meet as matrices, nothing is left out.

    With unit False the score is the plain inner product.
    """
    schema = f"_q {_kind(queries, qid)}, _g {_kind(gallery, gid)}, score double"
    best = _met(queries, gallery, qid, gid, vector).applyInArrow(partial(_best_of_block, k, exclude_self, unit), schema)
    return top_k(best, ["_q"], [F.desc("score"), F.col("_g")], k).select(F.col("_q").alias(qid), "rank", F.col("_g").alias(gid), "score")


def best_by_group(queries: DataFrame, gallery: DataFrame, qid: str, gid: str, vector: str, group: str, exclude_self: bool = False) -> DataFrame:
    """The best cosine of each query in each group of the gallery, over all its vectors (A37): qid, group, score."""
    schema = f"_q {_kind(queries, qid)}, _t {_kind(gallery, group)}, score double"
    best = _met(queries, gallery, qid, gid, vector, F.col(group).alias("_t")).applyInArrow(partial(_best_of_groups, exclude_self), schema)
    return best.groupBy(F.col("_q").alias(qid), F.col("_t").alias(group)).agg(F.max("score").alias("score"))


def by_dimension(df: DataFrame, keys: list[str], vector: str, *keep: str) -> DataFrame:
    """One row for each component: keys, kept columns, d, x."""
    return df.select(*keys, *keep, F.posexplode(doubles(vector)).alias("d", "x"))


def _gather(long: DataFrame, keys: list[str], value: Column, out: str) -> DataFrame:
    per = long.groupBy(*keys, "d").agg(value.alias("_v"))
    return per.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "_v"))), lambda s: s["_v"]).alias(out))


def mean_vector(df: DataFrame, keys: list[str], vector: str, weight: Column | None = None, unit: bool = True) -> DataFrame:
    """Weighted mean by component, NULL components left out, then unit length."""
    w = F.lit(1.0) if weight is None else weight
    long = by_dimension(df.withColumn("_w", w), keys, vector, "_w").where("x IS NOT NULL AND NOT isnan(x)")
    out = _gather(long, keys, F.try_divide(F.sum(F.col("_w") * F.col("x")), F.sum("_w")), "vector")
    return out.withColumn("vector", normalise("vector")) if unit else out


def spread(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Mean over components of their standard deviation, and of all elements with one degree less."""
    long = by_dimension(df, keys, vector)
    per = long.groupBy(*keys, "d").agg(F.stddev_pop("x").alias("s"))
    return per.groupBy(*keys).agg(F.avg("s").alias("mean_std")).join(long.groupBy(*keys).agg(F.stddev_samp("x").alias("element_std")), keys)


def median_vector(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    return _gather(by_dimension(df, keys, vector), keys, F.median("x"), "vector")


def max_vector(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    return _gather(by_dimension(df, keys, vector), keys, F.max("x"), "vector")


def logsumexp_vector(df: DataFrame, keys: list[str], vector: str, weight: Column | None = None) -> DataFrame:
    """Smooth maximum by component: m + ln sum w exp(x - m), two passes."""
    long = by_dimension(df.withColumn("_w", F.lit(1.0) if weight is None else weight), keys, vector, "_w")
    top = long.groupBy(*keys, "d").agg(F.max("x").alias("_m"))
    return _gather(long.join(top, [*keys, "d"]), keys, F.max("_m") + F.ln(F.sum(F.col("_w") * F.exp(F.col("x") - F.col("_m")))), "vector")


def trimmed_mean(df: DataFrame, keys: list[str], vector: str, lo: float = 0.1, hi: float = 0.9, least: int = 4) -> DataFrame:
    """Mean of the vectors whose norm lies between two quantiles; of all with fewer than ``least``."""
    rows = df.withColumn("_n", norm(vector))
    edge = rows.groupBy(*keys).agg(F.percentile("_n", F.array(F.lit(lo), F.lit(hi))).alias("_q"), F.count("*").alias("_k"))
    kept = rows.join(edge, keys).where((F.col("_k") < least) | F.col("_n").between(F.col("_q")[0], F.col("_q")[1]))
    return mean_vector(kept, keys, vector, unit=False)


def chunk_variance(df: DataFrame, keys: list[str], vector: str, top: int = 4) -> DataFrame:
    """Length of the vector of component variances, and its largest components."""
    per = by_dimension(df, keys, vector).groupBy(*keys, "d").agg(F.var_pop("x").alias("v"))
    return per.groupBy(*keys).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("variance_norm"), F.slice(F.sort_array(F.collect_list("v"), asc=False), 1, top).alias("top"))


def topic_distribution(scores: DataFrame, key: str, topic: str, score: str, k: int, temperature: float) -> DataFrame:
    """The k best topics of each key, their softmax at a temperature, and that distribution's entropy."""
    from framewell.functions.values import softmax_over

    best = top_k(scores, [key], [F.desc(F.round(score, 9)), F.col(topic)], k)
    own = Window.partitionBy(key)
    best = best.withColumn("probability", softmax_over(F.col(score), own, temperature))
    return best.withColumn("entropy", -F.sum(F.col("probability") * F.ln(F.col("probability") + 1e-9)).over(own))


def entropy(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Entropy, normalised entropy and perplexity of a distribution."""
    p = F.col(weight) / F.sum(weight).over(Window.partitionBy(*keys))
    out = df.withColumn("_p", p).groupBy(*keys).agg((-F.sum(F.col("_p") * F.ln(F.col("_p") + 1e-12))).alias("entropy"), F.count("*").alias("_k"))
    return out.select(*keys, "entropy", F.when(F.col("_k") > 1, F.col("entropy") / F.ln("_k")).otherwise(0.0).alias("normalised"), F.exp("entropy").alias("perplexity"))


def consecutive_similarity(df: DataFrame, keys: list[str], order: str, vector: str) -> DataFrame:
    """Cosine to the row before and novelty, NULL first."""
    rows = df.withColumn("_p", F.lag(vector).over(Window.partitionBy(*keys).orderBy(order)))
    return rows.withColumn("similarity", cosine(vector, "_p")).withColumn("novelty", 1 - F.col("similarity")).drop("_p")


def start_end_shift(df: DataFrame, keys: list[str], order: str, vector: str, most: int = 3) -> DataFrame:
    """Cosine of the mean of the first and of the last min(most, max(1, n // 2)) vectors."""
    # Only the ends of a key travel; how many of them count follows from the number of its rows.
    k = df.groupBy(*keys).agg(F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.count("*") / 2))).alias("_k"))
    a, b = (mean_vector(top_k(df.select(*keys, order, vector), keys, [by], most).join(k, keys).where(F.col("rank") <= F.col("_k")), keys, vector, unit=False).withColumnRenamed("vector", name) for by, name in ((F.asc(order), "_a"), (F.desc(order), "_b")))
    return a.join(b, keys).select(*keys, cosine("_a", "_b").alias("shift_cosine"))


def _nearest_within(rows: pa.Table) -> pa.Table:
    """Of many small keys at once, each row's best cosine with another row of its key and dimension."""
    rows = rows.sort_by([("_key", "ascending"), ("_d", "ascending")])
    key, size = (pc.rank(rows[c], tiebreaker="dense").to_numpy().astype("int64") for c in ("_key", "_d"))
    item = pc.rank(rows["_id"], tiebreaker="dense").to_numpy()
    ends = np.flatnonzero((np.diff(key) != 0) | (np.diff(size) != 0)) + 1
    out, best = [np.empty(0, "int64")], [np.empty(0)]
    for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), rows.num_rows]):
        if hi - lo > 1:
            v, own = _matrix(rows.slice(lo, hi - lo), "_x"), item[lo:hi]
            step = max(1, _SCORES // (hi - lo))
            for at in range(0, hi - lo, step):
                s = np.round(v[at : at + step] @ v.T, 12)
                s[own[at : at + step, None] == own] = -np.inf
                m = s.max(axis=1)
                found = np.flatnonzero(m > -np.inf)
                out.append(found + lo + at), best.append(m[found])
    return pa.table({"_q": rows["_id"].take(pa.array(np.concatenate(out))), "score": np.concatenate(best)})


def uniqueness(df: DataFrame, keys: list[str], item: str, vector: str, repeat: float = 0.97) -> DataFrame:
    """Within a key, each vector's nearest other one: repetition ratio, p95 similarity, diversity.

    The nearest one is found in blocks that meet as matrices, the mean from the key's mean vector: no pair is a row. Many
    small keys share a task's call; a large one is dealt in blocks of its own. Vectors that are unusable or zero, and a
    key's only vector, take no part.
    """
    from framewell.sources.files import cut

    rows = df.select(*keys, F.col(item).alias("_item"), normalise(vector).alias("_x"), F.to_json(F.struct(*keys, item)).alias("_id")).where(usable(vector) & (norm(vector) > 0))
    rows = cut(rows)
    sized = rows.join(rows.groupBy(*keys).agg(F.count("*").alias("_c")), keys)
    bundles = max(1, -(-rows.count() // QUERY_ROWS))
    few = sized.where(F.col("_c") <= QUERY_ROWS).select("_id", "_x", F.size("_x").alias("_d"), F.to_json(F.struct(*keys)).alias("_key"), F.pmod(F.xxhash64(*keys), F.lit(bundles)).alias("_bundle"))
    few = few.groupBy("_bundle").applyInArrow(_nearest_within, "_q string, score double")
    many = sized.where(F.col("_c") > QUERY_ROWS)
    if rows.groupBy(*keys).count().where(F.col("count") > QUERY_ROWS).limit(1).count():
        met = _met(many, many, "_id", "_id", "_x", by=keys, size="_c").applyInArrow(partial(_best_of_block, 1, True, True), "_q string, _g string, score double")
        few = few.unionByName(met.select("_q", "score"))
    near = few.groupBy(F.col("_q").alias("_id")).agg(F.max("score").alias("_m")).join(rows.select(*keys, "_item", "_id"), "_id")
    near = near.join(_mean_similarity(rows.select(*keys, "_item", F.col("_x").alias("_v")), keys, "_item"), [*keys, "_item"])
    return near.groupBy(*keys).agg(F.count("*").alias("n"), F.avg((F.col("_m") >= repeat).cast("int")).alias("repetition_ratio"), F.percentile("_m", F.lit(0.95)).alias("p95_similarity"), (1 - F.avg("mean_similarity")).alias("diversity"))


def mean_similarity(df: DataFrame, keys: list[str], item: str, vector: str) -> DataFrame:
    """Mean cosine of each vector to the others of its key (J16): from the key's mean vector, so no pair is formed.

    The sum of a unit vector's products with all others is its product with their sum. NULL where it is alone.
    """
    return _mean_similarity(df.where(usable(vector) & (norm(vector) > 0)).select(*keys, item, normalise(vector).alias("_v")), keys, item)


def _mean_similarity(unit: DataFrame, keys: list[str], item: str) -> DataFrame:
    mean = mean_vector(unit, keys, "_v", unit=False).join(unit.groupBy(*keys).agg(F.count("*").alias("_n")), keys)
    all_of = F.col("_n") * dot("_v", "vector") - dot("_v", "_v")
    return unit.join(mean, keys).select(*keys, item, F.try_divide(all_of, F.col("_n") - 1).alias("mean_similarity"))


def cosine_pairs(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Cosines of all pairs of the named vector columns (V03): columns a_b, NULL by the rules of ``cosine``."""
    return df.select(*keys, *(cosine(a, b).alias(f"{a}_{b}") for i, a in enumerate(names) for b in names[i + 1 :]))


def cosine_to_mean(one: DataFrame, many: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Cosine of a key's vector with the mean of the unit vectors of its many rows, and how many they are (V05); 0 without any."""
    unit = many.where(usable(vector) & (norm(vector) > 0)).select(*keys, normalise(vector).alias(vector))
    mean = mean_vector(unit, keys, vector).join(unit.groupBy(*keys).agg(F.count("*").alias("n_many")), keys)
    return one.join(mean, keys, "left").select(*keys, F.coalesce("n_many", F.lit(0)).alias("n_many"), cosine(vector, "vector").alias("cosine"))


def _vector_ids(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else hashlib.sha256(np.asarray(v, dtype="<f4").tobytes()).hexdigest()[:24])


def vector_id(v: Column | str) -> Column:
    """First 24 hex digits of the SHA-256 of a vector's little-endian float32 bytes; NULL without a vector."""
    return F.pandas_udf(_vector_ids, StringType())(_c(v))


def first_vector(*columns: str) -> Column:
    """The first usable vector in configured order."""
    return F.coalesce(*(F.when(usable(c) & (norm(c) > 0), F.col(c)) for c in columns))


def upsert(index: DataFrame, changed: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """An index table with rows replaced, added and removed by key."""
    gone = changed.select(key).union(removed.select(key))
    return index.join(gone, key, "left_anti").unionByName(changed.join(removed.select(key), key, "left_anti"))
