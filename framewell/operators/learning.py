"""Model fitting, folds and graph planning (L01-L12 and L15 of the survey; L13 is in rules, L14 in profile)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.functions.values import finite


def fit_heads(df: DataFrame, features: list[str], heads: dict[str, str], rounds: int = 10, depth: int = 3, seed: int = 7) -> dict[str, PipelineModel]:
    """One regressor for each target, on the rows its mask column allows."""
    assemble = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    out = {}
    for target, mask in heads.items():
        model = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol=f"pred_{target}", maxIter=rounds, maxDepth=depth, seed=seed)
        out[target] = Pipeline(stages=[assemble, model]).fit(df.where((F.col(mask) == 1) & finite(target).isNotNull()))
    return out


def predict(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Predictions of all heads."""
    for m in models.values():
        df = m.transform(df).drop("_features")
    return df


def save_models(models: dict[str, PipelineModel], path: str) -> None:
    """All heads below one path, for scoring jobs."""
    for name, m in models.items():
        m.write().overwrite().save(f"{path}/{name}")


def load_models(path: str, heads: list[str]) -> dict[str, PipelineModel]:
    return {name: PipelineModel.load(f"{path}/{name}") for name in heads}


def out_of_fold(df: DataFrame, features: list[str], target: str, fold: str, folds: int, **fit) -> DataFrame:
    """Each row predicted by a model that has not seen its fold, missing features by the other folds' medians."""
    parts = None
    for k in range(folds):
        rest, own = df.where(F.col(fold) != k), df.where(F.col(fold) == k)
        m = rest.agg(*(F.median(finite(f)).alias(f) for f in features)).first()
        fill = {f: F.coalesce(finite(f), F.lit(m[f] if m[f] is not None else 0.0)) for f in features}
        model = fit_heads(rest.withColumns(fill).withColumn("_on", F.lit(1)), features, {target: "_on"}, **fit)
        part = predict(own.withColumns(fill), model)
        parts = part if parts is None else parts.unionByName(part)
    return parts


#: Folds times features whose sums a row adds to at a time; more features are read in passes.
_FOLD_SUMS = 64


def select_by_fold(df: DataFrame, features: list[str], target: str, fold: str, k: int) -> DataFrame:
    """For each fold the k features of largest |Spearman| with the target on the other folds (L05): fold, rank, feature.

    A row trains every fold but its own, yet none is repeated: a value has a rank for each fold, from its counts on the
    others. Features' ranks join the rows, of which short tables are broadcast; their sums by value of the target meet the
    target's ranks, so that of the rows only these sums are shuffled.
    """
    from framewell.operators.ranks import top_k

    # Folds are few, and only their numbers come to the driver.
    folds = [r[0] for r in df.select(fold).where(F.col(fold).isNotNull()).distinct().orderBy(fold).collect()]
    if not folds:
        return df.select(F.col(fold).alias("fold"), F.lit(0).alias("rank"), F.lit("").alias("feature")).limit(0)
    each = max(1, _FOLD_SUMS // len(folds))
    parts = [_fold_spearman(df, features[i : i + each], target, fold, folds) for i in range(0, len(features), each)]
    s = reduce(DataFrame.unionByName, parts)
    return top_k(s, ["fold"], [F.desc(F.round(F.abs("spearman"), 9)), F.col("feature")], k).select("fold", "rank", "feature")


def _fold_spearman(df: DataFrame, features: list[str], target: str, fold: str, folds: list) -> DataFrame:
    """fold, feature, spearman on the rows of the other folds where feature and target are finite; no row where there are none."""
    from framewell.functions.sizes import small
    from framewell.operators.ranks import centred_rank, running_sums
    from framewell.sources.files import cut

    xs = [f"_x{i}" for i in range(len(features))]
    rows = df.where(F.col(fold).isNotNull()).select(F.col(fold).alias("_fold"), finite(target).alias("_y"), *(finite(f).alias(x) for f, x in zip(features, xs))).where("_y IS NOT NULL")
    trains = [F.col("_fold") != F.lit(f) for f in folds]
    cs = [f"c{i}" for i in range(len(folds))]
    counts = cut(rows.unpivot(["_fold", "_y"], xs, "_feature", "_value").groupBy("_feature", "_value").agg(*(F.count_if(t).alias(c) for t, c in zip(trains, cs))))
    gaps = {r[0] for r in counts.where("_value IS NULL").select("_feature").collect()}
    sums = running_sums(counts.where("_value IS NOT NULL"), ["_feature"], "_value", cs)
    ranks = cut(sums.select("_feature", "_value", *cs, *(centred_rank(c).alias(f"r_{c}") for c in cs)))
    spread = {r[0]: r for r in ranks.groupBy("_feature").agg(*(F.sum(F.col(c) * F.col(f"r_{c}") * F.col(f"r_{c}")).alias(c) for c in cs)).collect()}
    xs_known = [x for x in xs if x in spread]
    for x in xs_known:
        own = small(ranks.where(F.col("_feature") == x).select(F.col("_value").alias(x), F.array(*(f"r_{c}" for c in cs)).alias(f"r{x}")))
        rows = rows.join(own, x, "left")
    # The target's counts are the same for all features that have no gaps.
    pairs = {x: [c + x if x in gaps else c for c in cs] for x in xs_known}
    ys = {c: F.count_if(t) for t, c in zip(trains, cs)} | {c: F.count_if(t & F.col(x).isNotNull()) for x in xs_known if x in gaps for t, c in zip(trains, pairs[x])}
    adds = {f"s{i}{x}": F.sum(F.when(t, F.col(f"r{x}")[i])) for x in xs_known for i, t in enumerate(trains)}
    by_y = rows.groupBy("_y").agg(*(v.alias(n) for n, v in (ys | adds).items()))
    by_y = running_sums(by_y, [], "_y", list(ys))
    squares = [F.sum(F.col(c) * centred_rank(c) * centred_rank(c)).alias(f"v{c}") for c in ys]
    wide = by_y.agg(*squares, *(F.max(f"{c}_all").alias(f"n{c}") for c in ys), *(F.sum(F.coalesce(F.col(f"s{i}{x}"), F.lit(0.0)) * centred_rank(c)).alias(f"p{i}{x}") for x in xs_known for i, c in enumerate(pairs[x])))
    found = [
        F.struct(F.lit(folds[i]).alias("fold"), F.lit(f).alias("feature"), F.col(f"n{c}").alias("n"), F.when(F.col(f"n{c}") >= 2, F.try_divide(F.col(f"p{i}{x}"), F.sqrt(F.col(f"v{c}") * F.lit(spread[x][cs[i]])))).alias("spearman"))
        for f, x in zip(features, xs) if x in spread for i, c in enumerate(pairs[x])
    ]
    if not found:
        return df.select(F.col(fold).alias("fold"), F.lit("").alias("feature"), F.lit(0.0).alias("spearman")).limit(0)
    return wide.select(F.explode(F.array(*found)).alias("s")).where("s.n > 0").select("s.fold", "s.feature", "s.spearman")


def permutation_importance(df: DataFrame, model: PipelineModel, features: list[str], target: str, key: str, seed: int = 7) -> DataFrame:
    """Rise of the mean absolute error when one feature is dealt anew among the rows."""
    from framewell.operators.ranks import numbered

    pred = f"pred_{target}"
    base = model.transform(df).agg(F.avg(F.abs(F.col(target) - F.col(pred)))).first()[0]
    rows = []
    own = numbered(df, [F.col(key)], "_i")
    for f in features:
        dealt = numbered(df.select(F.col(f).alias("_f"), F.xxhash64(F.lit(f"{seed}{f}"), F.col(key)).alias("_h")), [F.col("_h")], "_i").select("_i", "_f")
        mixed = own.join(dealt, "_i").withColumn(f, F.col("_f"))
        rows.append((f, model.transform(mixed).agg(F.avg(F.abs(F.col(target) - F.col(pred)))).first()[0] - base))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def synthetic_targets(df: DataFrame, key: str, horizons: dict[str, float], seed: int = 7) -> DataFrame:
    """Seeded targets that grow with the horizon, and masks."""
    u = lambda tag: F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}{tag}:"), F.col(key).cast("string")), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    base = 5 + 3 * u("base")
    return df.withColumns({f"target_{h}": base + F.log1p(F.lit(d)) * (0.5 + u(h)) for h, d in horizons.items()}).withColumns({f"mask_{h}": (u(f"m{h}") < 0.9).cast("double") for h in horizons})


def segment_1d(df: DataFrame, value: str, k: int, seed: int = 7) -> DataFrame:
    """K-means of one value, clusters numbered by their centres; uniform over the range when there are too few values."""
    distinct = df.select(value).where(finite(value).isNotNull()).distinct().limit(k + 1).count()
    if distinct <= k:
        lo, hi = df.agg(F.min(finite(value)), F.max(finite(value))).first()
        width = ((hi - lo) / k or 1.0) if lo is not None else 1.0
        return df.withColumn("segment", F.least(F.floor((finite(value) - F.lit(lo)) / width), F.lit(k - 1)).cast("int"))
    ready = VectorAssembler(inputCols=[value], outputCol="_v", handleInvalid="skip").transform(df)
    model = KMeans(featuresCol="_v", predictionCol="_c", k=k, seed=seed).fit(ready)
    order = sorted(range(len(model.clusterCenters())), key=lambda i: model.clusterCenters()[i][0])
    rank = F.create_map(*(x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i))))
    return model.transform(ready).withColumn("segment", F.try_element_at(rank, F.col("_c"))).drop("_v", "_c")


def topo_order(nodes: dict[str, list[str]], wanted: list[str] | None = None) -> list[str]:
    """Dependencies before dependents, names in order among equals; a subset pulls in what it needs; cycles are an error."""
    need, todo = set(), list(wanted if wanted is not None else nodes)
    while todo:
        n = todo.pop()
        if n not in nodes:
            raise KeyError(n)
        if n not in need:
            need.add(n)
            todo += nodes[n]
    waiting, out = {n: {d for d in nodes[n]} for n in need}, []
    while waiting:
        ready = sorted(n for n, deps in waiting.items() if not deps)
        if not ready:
            raise ValueError(f"cycle among {sorted(waiting)}")
        out += ready
        waiting = {n: deps - set(ready) for n, deps in waiting.items() if n not in ready}
    return out


def weighted_score(columns: dict[str, float]) -> F.Column:
    """Weighted mean of the scores that are there."""
    total = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in columns.items()), F.lit(0.0))
    value = sum((F.coalesce(F.col(c), F.lit(0.0)) * w for c, w in columns.items()), F.lit(0.0))
    return F.try_divide(value, total)


def melt_index(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Wide artifact paths as rows, empty ones left out."""
    return df.unpivot(keys, columns, "component", "path").where(F.trim(F.coalesce("path", F.lit(""))) != "")
