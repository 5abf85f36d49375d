"""Streams of state machines against plain Python runs, in one go and with a restart in the middle."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from framewell.streaming import jobs as J
from framewell.streaming import machines as M
from framewell.streaming import tail as E

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def run_in_parts(spark, tmp_path, rows, schema, parts, job, name):
    """The rows in order of time, in as many batches; the query stops after each and goes on from its checkpoint."""
    rows = sorted(rows, key=lambda r: (r[2], r[1]))
    source, out, state = (f"file://{tmp_path}/{name}-{x}" for x in ("in", "out", "state"))
    edge = [len(rows) * i // parts for i in range(parts + 1)]
    for a, b in zip(edge, edge[1:]):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(source)
        stream = J.file_stream(spark, source, spark.createDataFrame([], schema).schema, 1)
        job(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).collect()


def plain_circuits(rows, rules):
    """Decisions by event, and changes of state, from sets and lists alone."""
    decided, changes = {}, []
    by_key = defaultdict(list)
    for key, event, at, failed in sorted(rows, key=lambda r: (r[2], r[1])):
        by_key[key].append((event, round((at - START).total_seconds() * 1000), bool(failed)))
    for key, events in by_key.items():
        state, opened, good, bad, trips = "closed", None, 0, [], 0
        for event, t, failed in events:
            if state == "open" and t >= opened + rules.cooldown:
                state = "half_open"
                changes.append((key, opened + rules.cooldown, state))
            passed = state != "open"
            old = state
            if passed and failed:
                bad = [x for x in bad if x >= t - rules.window] + [t]
                if state == "half_open" or len(bad) >= rules.failures:
                    state, opened, good, trips = "open", t, 0, trips + 1
            elif passed and state == "half_open":
                good += 1
                if good == rules.successes:
                    state, good = "closed", 0
            if state != old:
                changes.append((key, t, state))
            decided[event] = (key, passed, state, trips)
    return decided, changes


@pytest.mark.parametrize("parts", [1, 3])
def test_circuits_open_half_open_and_close(spark, tmp_path, parts):
    rng = random.Random(parts)
    rules = M.CircuitRules(failures=3, successes=2, window=20_000, cooldown=30_000)
    rows, at = [], {k: 0 for k in "abcd"}
    for i in range(240):
        k = rng.choice("abcd")
        at[k] = max(at.values()) if rng.random() < 0.5 else at[k] + rng.randrange(9000)
        rows.append((k, i, START + timedelta(milliseconds=at[k]), rng.random() < (0.8 if i % 60 < 30 else 0.1) if i % 7 else None))
    # Late rows see the state as it is, so the comparison takes rows in order.
    rows = [(k, i, t, f) for i, (k, _, t, f) in enumerate(sorted(rows, key=lambda r: r[2]))]
    got = run_in_parts(spark, tmp_path, rows, "key string, event_id long, at timestamp, failed boolean", parts, lambda s: M.circuits(s, rules), "circuit")
    decided, changes = plain_circuits(rows, rules)
    base = int(START.timestamp() * 1000)
    assert {r.event_id: (r.key, r.allowed, r.state, r.trips) for r in got if r.event_id is not None} == decided
    told = [(r.key, r["at"] - base, r.state) for r in got if r.event_id is None]
    assert len(set(told)) == len(told) and set(told) >= set(changes)
    # What timers add beyond the last row of a key is the end of its cooldown.
    assert all(state == "half_open" for *_, state in set(told) - set(changes))
    assert {s for *_, s, _ in decided.values()} == {"closed", "open", "half_open"}


def plain_group(rows, rules, end):
    out = set()
    by_key = defaultdict(dict)
    for message, _, at, action, priority in rows:
        by_key[message].setdefault(action, (round((at - START).total_seconds() * 1000), priority))
    for message, own in by_key.items():
        if "add" not in own:
            continue
        t, priority = own["add"]
        ack = own.get("ack", (None,))[0]
        ack = ack if ack is not None and ack >= t else None
        for n in range(1, rules.deliveries + 2):
            due = t + (n - 1) * rules.idle
            if n > 1 and ack is not None and ack < due:
                out.add((message, ack, priority, None, n - 1, "done"))
                break
            if n > 1 and due > end:
                break
            dead = n > rules.deliveries
            out.add((message, due, priority, None if dead else (message + n - 1) % rules.consumers, n - dead, "dead" if dead else "pending"))
    return out


@pytest.mark.parametrize("parts", [1, 3])
def test_failed_deliveries_come_back_and_acknowledged_ones_do_not(spark, tmp_path, parts):
    rng = random.Random(parts)
    rules = M.GroupRules(consumers=3, idle=10_000, deliveries=3)
    rows, event = [], 0
    for m in range(80):
        t = rng.randrange(100_000)
        rows.append((m, event, t, "add", m % 3))
        for ack in ([] if m % 4 == 0 else [rng.randrange(50_000)] if m % 4 < 3 else [5, 7]):
            event += 1
            rows.append((m, event, t + ack, "ack", None))
        event += 1
    rows += [(500, event, 400_000, "add", 1), (501, event + 1, 3, "ack", 0)]
    rows = [(m, e, START + timedelta(milliseconds=t), a, p) for m, e, t, a, p in rows]
    got = run_in_parts(spark, tmp_path, rows, "message long, event_id long, at timestamp, action string, priority int", parts, lambda s: M.consumer_group(s, rules), "group")
    base = int(START.timestamp() * 1000)
    told = [(r.message, r["at"] - base, r.priority, r.consumer, r.deliveries, r.status) for r in got]
    assert len(told) == len(set(told)) and set(told) == plain_group(rows, rules, 399_999)
    assert {"done", "dead", "pending"} == {x[-1] for x in told}


def log_rows(count=120):
    rng = random.Random(5)
    return [(rng.choice("xyz"), i, START + timedelta(milliseconds=rng.randrange(40)), rng.choice(["progress_a", "component_restart", "other"]), rng.choice(["clip", "flow", None])) for i in range(count)]


def test_tail_from_any_cursor_gives_the_later_events_in_order(spark, tmp_path):
    rows = log_rows()
    path = f"file://{tmp_path}/log"
    E.write_log(E.log_ids(spark.createDataFrame(rows, "run string, event_id long, at timestamp, kind string, component string"), "run", "at", "event_id"), path, "run")
    own = sorted((r for r in rows if r[0] == "y"), key=lambda r: (r[2], r[1]))
    ids = {r.event_id: E.Cursor(r.ms, r.seq) for r in spark.read.parquet(path).where("run = 'y'").collect()}
    for i in (0, 1, len(own) // 2, len(own) - 1):
        page, cursor = E.tail(spark, path, "run", "y", ids[own[i][1]], 1000)
        assert [r.event_id for r in page.collect()] == [r[1] for r in own[i + 1 :]]
        assert cursor == ids[own[-1][1]]
    assert E.tail(spark, path, "run", "none")[1] == E.Cursor()


@pytest.mark.parametrize("component", [None, "clip"])
def test_pages_follow_each_other_without_gap_or_repeat(spark, tmp_path, component):
    rows = log_rows(90)
    path = f"file://{tmp_path}/log"
    E.write_log(E.log_ids(spark.createDataFrame(rows, "run string, event_id long, at timestamp, kind string, component string"), "run", "at", "event_id"), path, "run")
    seen, cursor = [], E.Cursor()
    while True:
        page, after = E.tail(spark, path, "run", "x", cursor, 7, None if component is None else F.col("component") == component)
        got = [r.event_id for r in page.collect()]
        seen += got
        if not got:
            break
        cursor = after
    assert seen == [r[1] for r in sorted((r for r in rows if r[0] == "x" and component in (None, r[4])), key=lambda r: (r[2], r[1]))]
    assert E.tail(spark, path, "run", "x", cursor)[1] in (cursor, after)


def test_tail_pushes_the_run_and_the_cursor_to_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    E.write_log(E.log_ids(spark.createDataFrame(log_rows(30), "run string, event_id long, at timestamp, kind string, component string"), "run", "at", "event_id"), path, "run")
    page, _ = E.tail(spark, path, "run", "x", E.Cursor(1704067200005, 0))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ms,1704067200005)" in plan and "EqualTo(run,x)" in plan
