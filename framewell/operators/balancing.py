"""Order-dependent acceptance with feedback (T08, F06 of the survey): each accepted row moves the shares that judge the next.

A group's rows are judged one after the other, so they stand in one task, which takes them as a sorted stream: memory
holds the group's counts and its last accepted values, never its rows. Groups are what scales; finer ones spread wider.
"""

from __future__ import annotations

import math
import random
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"


@dataclass(frozen=True)
class Share:
    """How one field is to be spread. coefficient: its weight, 0 for none. buckets: (low, high) bounds of numbers, both inclusive,
    None for open. targets: the share of each value (a mapping), of each bucket (a list), or None for equal ones."""

    coefficient: float = 1.0
    buckets: tuple[tuple[int | None, int | None], ...] | None = None
    targets: dict[str, float] | list[float] | None = None
    unknown_share: float | None = None
    max_share: float | None = None


@dataclass(frozen=True)
class Balance:
    """hard: a score of least is enough; soft: the score is the chance; mixed: hard for strict fields, else a chance that grows with laxity."""

    fields: dict[str, Share] = field(default_factory=dict)
    mode: str = "mixed"
    least: float = 0.35
    without_values: bool = True
    seed: int = 0


def _name(i: int, low: int | None, high: int | None) -> str:
    return f"{i + 1:02d} {'min' if low is None else low}-{'max' if high is None else high}"


def label(value: Column, share: Share) -> Column:
    """What a field's value counts as: its bucket, out_of_range, or itself; null is unknown."""
    if not share.buckets:
        return F.coalesce(value.cast("string"), F.lit(UNKNOWN))
    whole = value.try_cast("double").cast("long")
    out = F.when(whole.isNull(), UNKNOWN)
    for i, (low, high) in enumerate(share.buckets):
        inside = F.lit(True) if low is None else whole >= low
        out = out.when(inside if high is None else inside & (whole <= high), _name(i, low, high))
    return out.otherwise("out_of_range")


class Counts:
    """The accepted rows of a group by field and value."""

    def __init__(self, balance: Balance):
        self.balance, self.random = balance, random.Random(balance.seed)
        self.shares = {f: s for f, s in balance.fields.items() if s.coefficient > 0}
        self.seen: dict[str, Counter] = {f: Counter() for f in self.shares}
        self.total = 0
        self.named = {f: [_name(i, *b) for i, b in enumerate(s.buckets or ())] for f, s in self.shares.items()}

    def target(self, name: str, value: str) -> float:
        share, named = self.shares[name], self.named[name]
        if isinstance(share.targets, dict) and value in share.targets:
            return max(0.001, share.targets[value])
        if isinstance(share.targets, list) and value in named[: len(share.targets)]:
            return max(0.001, share.targets[named.index(value)])
        return 1 / max(1, len(self.seen[name].keys() | set(named)))

    def penalty(self, name: str, value: str) -> float:
        """0 while a value's share, the row included, is within its target; then its excess over it, 1 at most."""
        if not self.total:
            return 0.0
        share, has = self.shares[name], self.seen[name][value]
        caps = [c for c in (share.unknown_share if value == UNKNOWN else None, share.max_share) if c is not None]
        if any(has / self.total >= c for c in caps):
            return 1.0
        target, then = self.target(name, value), (has + 1) / (self.total + 1)
        return 0.0 if then <= target else min(1.0, (then - target) / max(target, 0.001))

    def judge(self, values: dict[str, str]) -> tuple[float, str | None]:
        """Score and, if the row is rejected, the field with the largest penalty."""
        if not values:
            return 1.0, None if self.balance.without_values else "score"
        penalties = {f: self.penalty(f, v) for f, v in values.items()}
        weight = sum(self.shares[f].coefficient for f in values)
        score = round(max(0.0, 1 - sum(self.shares[f].coefficient * p for f, p in penalties.items()) / weight), 4)
        strict = min(1.0, weight / len(values))
        if self.balance.mode == "hard" or self.balance.mode == "mixed" and strict >= 0.75 and score < self.balance.least:
            accepted = score >= self.balance.least
        else:
            chance = score if self.balance.mode == "soft" else 1 - strict + strict * score
            accepted = self.random.random() <= chance
        return score, None if accepted else max(penalties, key=penalties.get)

    def accept(self, values: dict[str, str]) -> None:
        self.total += 1
        for f, v in values.items():
            self.seen[f][v] += 1


class Recent:
    """Mean and sample deviation of the last accepted values, carried from row to row."""

    def __init__(self, history: int):
        self.kept: deque[float] = deque(maxlen=history)
        self.shift = self.one = self.two = 0.0

    def outlier(self, v: float, least: int, z: float) -> bool:
        n = len(self.kept)
        if n < max(least, 2):
            return False
        deviation = math.sqrt(max(0.0, self.two - self.one * self.one / n) / (n - 1))
        return deviation > 0 and (v - self.shift - self.one / n) / deviation > z

    def add(self, v: float) -> None:
        # Sums are of the differences to the first value, which keep their digits.
        if not self.kept:
            self.shift = v
        if len(self.kept) == self.kept.maxlen:
            self.one, self.two = self.one - (self.kept[0] - self.shift), self.two - (self.kept[0] - self.shift) ** 2
        self.kept.append(v)
        self.one, self.two = self.one + (v - self.shift), self.two + (v - self.shift) ** 2


def accept(df: DataFrame, group: str, order: str, channel: str, value: str, cap: int, history: int = 500, least: int = 20, z: float = 3.0, balance: Balance | None = None) -> DataFrame:
    """df's group, order, channel and value (and the labels of balanced fields), with score and reason (NULL: accepted).

    In each group, in order: a one-sided outlier test against the last ``history`` accepted values (sample deviation, at
    least ``least`` of them), a cap a channel, then the balance. Only accepted rows count for what follows.
    """
    shares = {f: s for f, s in balance.fields.items() if s.coefficient > 0} if balance else {}
    columns = [group, order, channel, value]
    rows = df.select(*columns, *(label(F.col(f), s).alias(f"{f}_label") for f, s in shares.items()))
    schema = rows.limit(0).withColumns({"score": F.lit(None).cast("double"), "reason": F.lit(None).cast("string")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, recent, used, counts = object(), Recent(history), Counter(), None
        for batch in batches:
            labels = [batch.column(f"{f}_label").to_pylist() for f in shares]
            scores, reasons = [], []
            for i, (g, c, v) in enumerate(zip(*(batch.column(x).to_pylist() for x in (group, channel, value)))):
                if g != now:
                    now, recent, used = g, Recent(history), Counter()
                    counts = Counts(balance) if shares else None
                number = v is not None and not math.isnan(v)
                score = reason = None
                if number and recent.outlier(v, least, z):
                    reason = "outlier"
                elif used[c] >= cap:
                    reason = "channel_cap"
                elif counts is not None:
                    values = {f: x[i] for f, x in zip(shares, labels)}
                    score, worst = counts.judge(values)
                    reason = f"balancer_{worst}" if worst else None
                if reason is None:
                    used[c] += 1
                    if number:
                        recent.add(v)
                    if counts is not None:
                        counts.accept(values)
                scores.append(score)
                reasons.append(reason)
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64()), pa.array(reasons, pa.string())], names=[*batch.schema.names, "score", "reason"])

    out = rows.repartition(group).sortWithinPartitions(group, order).mapInArrow(run, schema)
    return out if shares else out.drop("score")
