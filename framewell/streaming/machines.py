"""State machines over event-time streams: circuit breakers (T11) and consumer groups with acknowledgement.

Both keep their state by key in Spark's state store and take a key's rows in the order of time, whatever batches they
come in. What falls due between two rows of a key is worked off before the later one; what falls due with no later row
is worked off by a timer, once the watermark has passed it. So results do not depend on how a stream is cut in batches,
as long as rows come in order of time; a row at or before the watermark is dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_store(spark: SparkSession) -> None:
    """State with timers needs the store that keeps its tables on disk."""
    spark.conf.set(_STORE, _ROCKS)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(["at", "event_id"], kind="stable")


@dataclass(frozen=True)
class CircuitRules:
    """Failures within ``window`` that open a circuit, successes that close it again, and how long it stays open (milliseconds)."""

    failures: int = 10
    successes: int = 3
    window: int = 60_000
    cooldown: int = 300_000


class Circuit:
    """One operation's circuit: refuses requests while open, tries again after the cooldown, closes after some successes."""

    def __init__(self, rules: CircuitRules, state: str = CLOSED, won: int = 0, opened: int = 0, trips: int = 0, failed: list[int] | None = None):
        self.rules, self.state, self.won, self.opened, self.trips, self.failed = rules, state, won, opened, trips, list(failed or [])

    def due(self) -> int | None:
        """When an open circuit is half open again."""
        return self.opened + self.rules.cooldown if self.state == OPEN else None

    def wake(self, now: int) -> int | None:
        """Half open if that is due: the time since which it has been."""
        due = self.due()
        if due is None or due > now:
            return None
        self.state = HALF_OPEN
        return due

    def request(self, now: int, failed: bool) -> tuple[bool, str | None]:
        """Whether a request passes, and the state its outcome leads to, if that changes."""
        if self.state == OPEN:
            return False, None
        before = self.state
        if failed:
            self.failed = [t for t in self.failed if now - t <= self.rules.window] + [now]
            if before == HALF_OPEN or len(self.failed) >= self.rules.failures:
                self.state, self.opened, self.won = OPEN, now, 0
                self.trips += 1
        elif before == HALF_OPEN:
            self.won += 1
            if self.won >= self.rules.successes:
                self.state, self.won = CLOSED, 0
        return True, self.state if self.state != before else None


CIRCUITS = "key string, event_id long, at long, allowed boolean, state string, trips int"


class _Circuits(StatefulProcessor):
    def __init__(self, rules: CircuitRules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("circuit", "state string, won int, opened long, trips int, failed array<bigint>")

    def _load(self) -> Circuit:
        return Circuit(self.rules, *(self.kept.get() or ()))

    def _save(self, key: Any, circuit: Circuit, due: int | None, out: list[tuple]) -> Iterator[pd.DataFrame]:
        self.kept.update((circuit.state, circuit.won, circuit.opened, circuit.trips, circuit.failed))
        if circuit.due() != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if circuit.due() is not None:
                self.handle.registerTimer(circuit.due())
        yield pd.DataFrame([(key[0], *x) for x in out], columns=["key", "event_id", "at", "allowed", "state", "trips"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        circuit, out = self._load(), []
        due = circuit.due()
        rows = _in_order(rows)
        for event_id, at, failed in zip(rows.event_id, rows["at"], rows.failed):
            now = int(at.value // 1_000_000)
            since = circuit.wake(now)
            if since is not None:
                out.append((None, since, None, HALF_OPEN, circuit.trips))
            allowed, changed = circuit.request(now, bool(failed))
            out.append((int(event_id), now, allowed, circuit.state, circuit.trips))
            if changed:
                out.append((None, now, None, changed, circuit.trips))
        yield from self._save(key, circuit, due, out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        circuit = self._load()
        since = circuit.wake(expiredTimerInfo.getExpiryTimeInMs())
        if since is not None:
            yield from self._save(key, circuit, None, [(None, since, None, HALF_OPEN, circuit.trips)])


def circuits(stream: DataFrame, rules: CircuitRules = CircuitRules(), late: str = "1 millisecond") -> DataFrame:
    """T11. stream(key, event_id, at timestamp, failed): a row for each request (allowed, state after it) and, without event_id,
    one for each change of state, with its time."""
    state_store(stream.sparkSession)
    rows = stream.select(F.col("key").cast("string").alias("key"), F.col("event_id").cast("long").alias("event_id"), "at", F.coalesce("failed", F.lit(False)).alias("failed"))
    return rows.withWatermark("at", late).groupBy("key").transformWithStateInPandas(_Circuits(rules), CIRCUITS, "append", "EventTime")


@dataclass(frozen=True)
class GroupRules:
    """Consumers of the group, milliseconds after which an unacknowledged delivery goes to the next one, and deliveries at most."""

    consumers: int = 3
    idle: int = 60_000
    deliveries: int = 3


class Message:
    """A message of a consumer group: pending from its delivery until it is acknowledged or dead."""

    def __init__(self, rules: GroupRules, priority: int = 0, first: int = 0, deliveries: int = 0, last: int = 0, status: str = "new"):
        self.rules, self.priority, self.first, self.deliveries, self.last, self.status = rules, priority, first, deliveries, last, status

    def due(self) -> int | None:
        return self.last + self.rules.idle if self.status == "pending" else None

    def deliver(self, at: int) -> tuple:
        self.deliveries, self.last, self.status = self.deliveries + 1, at, "pending"
        return at, self.priority, (self.first + self.deliveries - 1) % self.rules.consumers, self.deliveries, self.status

    def wake(self, now: int) -> list[tuple]:
        """Deliveries that are due by now: each to the next consumer; after the last one the message is dead."""
        out = []
        while (due := self.due()) is not None and due <= now:
            if self.deliveries >= self.rules.deliveries:
                self.status = "dead"
                out.append((due, self.priority, None, self.deliveries, self.status))
            else:
                out.append(self.deliver(due))
        return out

    def acknowledge(self, at: int) -> list[tuple]:
        """Only a pending message can be acknowledged; it never comes back."""
        if self.status != "pending":
            return []
        self.status = "done"
        return [(at, self.priority, None, self.deliveries, self.status)]


#: Messages of a shard of a consumer group; a batch's rows of a shard, and its pending messages, are in a worker's memory at once.
SHARD_MESSAGES = 10_000


def shards_for(messages: int, least: int = 64) -> int:
    """Shards of a group that takes so many messages in a batch or has them pending: memory follows the shard, not the stream."""
    return max(least, -(-messages // SHARD_MESSAGES))


DELIVERIES = "message long, at long, priority int, consumer int, deliveries int, status string"


class _Group(StatefulProcessor):
    """A shard of the group: its pending messages as a list, and one timer for the first that falls due."""

    def __init__(self, rules: GroupRules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("pending", "message long, priority int, first int, deliveries int, last long, status string")
        self.timer = handle.getValueState("timer", "at long")

    def _load(self) -> dict[int, Message]:
        return {m: Message(self.rules, *rest) for m, *rest in self.kept.get()} if self.kept.exists() else {}

    def _save(self, pending: dict[int, Message], out: list[tuple], rung: bool = False) -> Iterator[pd.DataFrame]:
        left = {n: m for n, m in pending.items() if m.status == "pending"}
        if left:
            self.kept.put([(n, m.priority, m.first, m.deliveries, m.last, m.status) for n, m in left.items()])
        else:
            self.kept.clear()
        was, due = self.timer.get(), min((m.due() for m in left.values()), default=None)
        if was is None or rung or was[0] != due:
            if was is not None and not rung:
                self.handle.deleteTimer(was[0])
            if due is None:
                self.timer.clear()
            else:
                self.handle.registerTimer(due)
                self.timer.update((due,))
        frame = pd.DataFrame(out, columns=["message", "at", "priority", "consumer", "deliveries", "status"])
        yield frame.astype({"consumer": "Int32"})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pending, out = self._load(), []
        rows = _in_order(rows)
        for number, at, action, priority in zip(rows.message, rows["at"], rows.action, rows.priority):
            number, now = int(number), int(at.value // 1_000_000)
            m = pending.get(number)
            told = m.wake(now) if m else []
            if action == "add" and (m is None or m.status != "pending"):
                m = pending[number] = Message(self.rules, int(priority), number % self.rules.consumers)
                told = [*told, m.deliver(now)]
            elif action == "ack" and m:
                told += m.acknowledge(now)
            out += [(number, *x) for x in told]
        yield from self._save(pending, out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        pending = self._load()
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        yield from self._save(pending, [(n, *x) for n, m in pending.items() for x in m.wake(now)], True)


def consumer_group(stream: DataFrame, rules: GroupRules = GroupRules(), late: str = "1 millisecond", shards: int = 64) -> DataFrame:
    """T13. stream(message, event_id, at timestamp, action: add or ack, priority): queues of all priorities are read together.

    A message is delivered when it is added; without an acknowledgement it goes to the next consumer after the idle time,
    and is dead after the last delivery. A row for each delivery (pending), acknowledgement (done) and end (dead). State is
    a few numbers for each pending message, in as many shards by message as the group should spread over (``shards_for``); an id that is
    added again after its end is a new message. Readers take a batch's rows by priority.
    """
    state_store(stream.sparkSession)
    rows = stream.select(F.pmod(F.hash("message"), F.lit(shards)).alias("shard"), F.col("message").cast("long").alias("message"), F.col("event_id").cast("long").alias("event_id"), "at", "action", F.coalesce(F.col("priority").cast("int"), F.lit(0)).alias("priority"))
    return rows.withWatermark("at", late).groupBy("shard").transformWithStateInPandas(_Group(rules), DELIVERIES, "append", "EventTime")
