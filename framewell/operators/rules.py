"""Predicates, rule tables and column selection (P01-P22 of the survey)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.sizes import small
from framewell.functions.values import empty_like, finite, lenient_double


def kept_columns(names: list[str], substrings: list[str], suffixes: list[str], exclude: list[str] = ()) -> list[str]:
    """Column names without those that hold a substring (in the full name or after __), end in a suffix or are excluded."""
    local = lambda n: n.split("__", 1)[-1]
    return [n for n in names if n not in exclude and not any(s in n or s in local(n) for s in substrings) and not any(n.endswith(s) or local(n).endswith(s) for s in suffixes)]


def column_filter(name: Column, substrings: list[str], suffixes: list[str]) -> Column:
    """The same as a predicate over long rows."""
    out = F.lit(True)
    for s in substrings:
        out = out & ~F.contains(name, F.lit(s))
    for s in suffixes:
        out = out & ~F.endswith(name, F.lit(s))
    return out


def stable_order(names: list[str], ids: list[str]) -> list[str]:
    """Ids first, as given, then features sorted."""
    return [i for i in ids if i in names] + sorted(n for n in names if n not in ids)


def namespace(long: DataFrame, keys: list[str], component: str, feature: str, value: str, order: str) -> DataFrame:
    """component__feature with the later artifact's value."""
    return long.groupBy(*keys, F.concat_ws("__", component, feature).alias("feature")).agg(F.max_by(value, F.struct(order, value)).alias(value))


LEAK = r"(_[123]$)|(snapshot_[0-9]+)"


def leakage_guard(names: list[str], allow: list[str] = ()) -> list[str]:
    """Names that carry the future: suffix _1, _2, _3 or snapshot_N."""
    return [n for n in names if n not in allow and re.search(LEAK, n)]


def leaks(name: Column, allow: list[str] = ()) -> Column:
    """Whether a column of names carries the future, as ``leakage_guard`` does for a list."""
    return ~name.isin(list(allow)) & name.rlike(LEAK) if allow else name.rlike(LEAK)


def leakage_audit(features: DataFrame, name: str, spec: DataFrame, targets: str = r"^target_") -> DataFrame:
    """Class of each feature: forbidden, target, mapped or unmapped (P07); spec lists the known names as ``name``."""
    known = spec.select(F.col("name").alias(name), F.lit(True).alias("_k"))
    c = F.col(name)
    return features.join(known, name, "left").select(name, F.when(c.rlike(LEAK), "forbidden").when(c.rlike(targets), "target").when(F.col("_k"), "mapped").otherwise("unmapped").alias("class"))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The first failing rule's reason, NULL when all pass."""
    out = None
    for reason, failed in rules:
        out = F.when(failed, reason) if out is None else out.when(failed, reason)
    return out


def age_bucket(age_days: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Half-open buckets [previous, edge), the first that holds; NULL is unknown."""
    out = F.when(age_days.isNull(), "unknown")
    for edge, name in edges:
        out = out.when(age_days < edge, name)
    return out.otherwise(last)


def numeric_bucket(value: Column, buckets: list[tuple[float, float]]) -> Column:
    """Closed buckets [low, high], the first that holds, labelled "NN low-high"; else overflow or unknown."""
    out = F.when(value.isNull(), "unknown")
    for i, (lo, hi) in enumerate(buckets):
        out = out.when((value >= lo) & (value <= hi), f"{i:02d} {lo:g}-{hi:g}")
    return out.otherwise("overflow")


def apply_rules(long: DataFrame, rules: DataFrame) -> DataFrame:
    """Warnings of range, enum and presence rules.

    rules: component (NULL for any), column (exact, or NULL), pattern (regex, or NULL), lo, hi, allowed (array or NULL),
    optional. An exact rule beats a pattern, a component's own beats any; text that is no number fails a range unless
    optional and empty. long: component, column, raw.
    """
    r = rules.select(F.col("component").alias("_rc"), F.col("column").alias("_rn"), "pattern", "lo", "hi", "allowed", "optional")
    distinct = long.select("component", "column").distinct()
    fits = (F.col("_rc").isNull() | (F.col("_rc") == F.col("component"))) & F.coalesce(F.col("_rn") == F.col("column"), F.regexp("column", F.col("pattern")), F.lit(False))
    rank = Window.partitionBy("component", "column").orderBy(F.col("_rn").isNull(), F.col("_rc").isNull(), "pattern")
    chosen = distinct.join(small(r), fits).withColumn("_p", F.row_number().over(rank)).where("_p = 1").drop("_p", "_rc", "_rn", "pattern")
    rows = long.join(chosen, ["component", "column"], "left")
    v = lenient_double("raw")
    ranged = F.col("lo").isNotNull() | F.col("hi").isNotNull()
    warning = (
        F.when(F.col("optional").isNull(), None).when(empty_like("raw"), F.when(F.col("optional"), None).otherwise("missing"))
        .when(F.col("allowed").isNotNull(), F.when(~F.array_contains("allowed", F.trim("raw")), "not_allowed"))
        .when(ranged & finite(v).isNull(), "not_numeric").when((v < F.col("lo")) | (v > F.col("hi")), "out_of_range")
    )
    return rows.select("component", "column", "raw", warning.alias("warning"))


def validate(wide: DataFrame, keys: list[str], ranges: list[tuple[str, float, float, str]], crosses: list[tuple[str, str, Column]] = ()) -> DataFrame:
    """Issues of each row (L13): (feature, low, high, severity) for values outside a closed range or not finite, and
    (name, severity, failing condition) over several columns. NULL breaks no range, and a condition that is NULL holds
    no issue. keys, feature, severity, value.
    """
    none = F.lit(None).cast("struct<feature: string, severity: string, value: double>")
    issue = lambda name, severity, bad, value: F.when(bad, F.struct(F.lit(name).alias("feature"), F.lit(severity).alias("severity"), value.cast("double").alias("value"))).otherwise(none)
    found = [issue(f, s, F.col(f).isNotNull() & (finite(f).isNull() | ~F.col(f).between(lo, hi)), F.col(f)) for f, lo, hi, s in ranges]
    found += [issue(n, s, bad, F.lit(None)) for n, s, bad in crosses]
    return wide.select(*keys, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*")


def flatten_meta(df: DataFrame, key: str, meta: str, longest: int = 40) -> DataFrame:
    """Map entries as rows: booleans as 0 and 1, numbers, short strings."""
    rows = df.select(key, F.explode(meta).alias("name", "raw"))
    flag = F.when(F.lower("raw") == "true", F.lit(1.0)).when(F.lower("raw") == "false", F.lit(0.0))
    return rows.select(key, "name", F.coalesce(flag, F.col("raw").try_cast("double")).alias("number"), F.when(F.col("raw").try_cast("double").isNull() & flag.isNull() & (F.length("raw") <= longest), F.col("raw")).alias("label"))


def numeric_leaves(df: DataFrame, keys: list[str]) -> DataFrame:
    """All numeric leaves of nested structs as dotted names."""
    from pyspark.sql import types as st

    def walk(schema: st.StructType, lead: str) -> list[str]:
        out = []
        for f in schema.fields:
            name = f"{lead}{f.name}"
            if isinstance(f.dataType, st.StructType):
                out += walk(f.dataType, f"{name}.")
            elif isinstance(f.dataType, (st.NumericType, st.BooleanType)) and name not in keys:
                out.append(name)
        return out

    leaves = walk(df.schema, "")
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in leaves)))
    return df.select(*keys, pairs.alias("_x")).select(*keys, "_x.name", "_x.value")


def contains_all(have: Column, want: Column) -> Column:
    """Map containment: every wanted entry is there."""
    return F.forall(F.map_keys(want), lambda k: F.try_element_at(have, k).eqNullSafe(F.try_element_at(want, k)))
