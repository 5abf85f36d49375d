"""Queries of state machines over streams: circuits, consumer groups, event tails."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.plans.common import table
from framewell.sources import files as S
from framewell.streaming import jobs as J
from framewell.streaming import machines as M
from framewell.streaming import tail as E

_DAY = 86_400_000
_CIRCUIT = M.CircuitRules(failures=3, successes=2, window=40 * _DAY, cooldown=15 * _DAY)
_GROUP = M.GroupRules(consumers=3, idle=10 * _DAY, deliveries=3)


def _stream(spark, rows):
    path = S.scratch(spark)
    rows.repartition("part").drop("part").write.parquet(path)
    return J.file_stream(spark, path, rows.drop("part").schema, 1_000_000)


def _events(spark, sf):
    return table(spark, sf, "events").where("ts IS NOT NULL AND user_id IS NOT NULL").withColumn("at", F.date_trunc("millisecond", F.col("ts").cast("timestamp")))


def t11_circuit_states(spark, sf):
    """Users as operations; clicks fail. Every request with its decision and the circuit's state after it."""
    e = _events(spark, sf).select(F.col("user_id").alias("key"), "event_id", "at", (F.col("event_type") == "click").alias("failed"), F.col("user_id").alias("part"))
    return J.run_to_end(M.circuits(_stream(spark, e), _CIRCUIT)).where("event_id IS NOT NULL").select("key", "event_id", "allowed", "state", "trips")


def t13_consumer_group(spark, sf):
    """Orders as messages of five queues, added on their day; two thirds are acknowledged, 0 to 39 days later."""
    o = table(spark, sf, "orders").where("o_orderdate IS NOT NULL").select(F.col("o_orderkey").alias("message"), F.col("o_orderdate").cast("timestamp").alias("added"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"))
    ack = F.timestamp_add("DAY", (F.col("message") % 40).cast("int"), F.timestamp_add("HOUR", F.lit(1), F.col("added")))
    rows = F.array(F.struct(F.lit(0).alias("event_id"), F.col("added").alias("at"), F.lit("add").alias("action")), F.struct(F.lit(1).alias("event_id"), ack.alias("at"), F.lit("ack").alias("action")))
    o = o.select("message", "priority", F.explode(rows).alias("r")).select("message", "priority", "r.*", F.col("message").alias("part")).where("action = 'add' OR message % 3 > 0")
    out = J.run_to_end(M.consumer_group(_stream(spark, o), _GROUP, shards=M.shards_for(table(spark, sf, "orders").count())))
    return out.groupBy("message").agg(F.max("priority").alias("priority"), F.count_if(F.col("status") == "pending").alias("delivered"), F.max("deliveries").alias("deliveries"), F.max_by("status", F.struct("at", "deliveries", F.col("status") != "pending")).alias("status"), F.count_distinct("consumer").alias("consumers"))


_SINCE = "2024-01-10"
_KINDS = ["processing_started", "component_started", "component_finished", "component_idle", "progress_bar", "stage_x", "processor_up", "resume_from_checkpoint", "other"]


def t16_event_tail(spark, sf):
    """Users as runs: what each has after the first event since its date; even event numbers belong to the component."""
    e = _events(spark, sf).select(F.col("user_id").alias("run"), "event_id", "at", F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("event_id") % len(_KINDS) + 1).cast("int")).alias("kind"))
    path = S.scratch(spark)
    E.write_log(E.log_ids(e, "run", "at", "event_id"), path, "run")
    log = spark.read.parquet(path)
    since = e.groupBy("run").agg(F.lit(_SINCE).cast("timestamp").alias("since"))
    return E.tail_runs(log, "run", E.cursors_since(log, "run", since), "kind", F.col("event_id") % 2 == 0).select("run", "place", "event_id", "reader_type")


_E = "events WHERE ts IS NOT NULL AND user_id IS NOT NULL"
QUERIES = {
    "t11_circuit_states": (t11_circuit_states, f"""WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS key, event_id, epoch_ms(ts) AS ms, event_type = 'click' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS i FROM {_E}),
      r AS (SELECT DISTINCT key, 0::BIGINT AS i, 'closed' AS st, 0 AS won, 0::BIGINT AS opened, 0 AS trips, []::BIGINT[] AS f, NULL::BIGINT AS event_id, NULL::BOOLEAN AS allowed FROM e
        UNION ALL
        SELECT key, i, CASE WHEN trip THEN 'open' WHEN st1 = 'half_open' AND won1 >= {_CIRCUIT.successes} THEN 'closed' ELSE st1 END, CASE WHEN trip OR won1 >= {_CIRCUIT.successes} THEN 0 ELSE won1 END, CASE WHEN trip THEN ms ELSE opened END, trips + trip::INT, f1, event_id, st1 <> 'open'
        FROM (SELECT *, failed AND st1 <> 'open' AND (st1 = 'half_open' OR len(f1) >= {_CIRCUIT.failures}) AS trip, won + (NOT failed AND st1 = 'half_open')::INT AS won1
          FROM (SELECT *, CASE WHEN failed AND st1 <> 'open' THEN list_append(list_filter(f, lambda x: ms - x <= {_CIRCUIT.window}), ms) ELSE f END AS f1
            FROM (SELECT e.key, e.i, e.ms, e.failed, e.event_id, r.won, r.opened, r.trips, r.f, CASE WHEN r.st = 'open' AND e.ms - r.opened >= {_CIRCUIT.cooldown} THEN 'half_open' ELSE r.st END AS st1 FROM r JOIN e ON e.key = r.key AND e.i = r.i + 1))))
      SELECT key, event_id, allowed, st AS state, trips FROM r WHERE i > 0"""),
    "t13_consumer_group": (t13_consumer_group, f"""WITH o AS (SELECT o_orderkey AS message, substr(o_orderpriority, 1, 1)::INT AS priority, epoch_ms(o_orderdate) AS t, CASE WHEN o_orderkey % 3 > 0 THEN epoch_ms(o_orderdate) + 3600000 + (o_orderkey % 40) * {_DAY} END AS ack FROM orders WHERE o_orderdate IS NOT NULL),
      w AS (SELECT greatest(max(t), max(ack)) - 1 AS w FROM o),
      d AS (SELECT o.*, w, least((coalesce(ack, w) - t) // {_GROUP.idle} + 1, {_GROUP.deliveries})::BIGINT AS n FROM o, w)
      SELECT message, priority, n AS delivered, n::INT AS deliveries, CASE WHEN ack < t + {_GROUP.idle * _GROUP.deliveries} THEN 'done' WHEN w >= t + {_GROUP.idle * _GROUP.deliveries} THEN 'dead' ELSE 'pending' END AS status, least(n, {_GROUP.consumers}) AS consumers FROM d"""),
    "t16_event_tail": (t16_event_tail, f"""WITH e AS (SELECT user_id AS run, event_id, epoch_ms(ts) AS ms, ['{"', '".join(_KINDS)}'][event_id % {len(_KINDS)} + 1] AS kind FROM {_E}),
      i AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ms, event_id) AS i FROM e),
      c AS (SELECT run, coalesce(min(i) FILTER (ms >= epoch_ms(TIMESTAMP '{_SINCE}')), 0) AS c FROM i GROUP BY 1)
      SELECT i.run, row_number() OVER (PARTITION BY i.run ORDER BY i)::INT AS place, event_id, CASE kind WHEN 'processing_started' THEN 'stage' WHEN 'component_started' THEN 'component_start' WHEN 'component_finished' THEN 'component_complete' WHEN 'progress_bar' THEN 'progress' WHEN 'stage_x' THEN 'stage' WHEN 'processor_up' THEN 'stage' WHEN 'resume_from_checkpoint' THEN 'stage' ELSE kind END AS reader_type
      FROM i JOIN c ON c.run = i.run WHERE i > c AND event_id % 2 = 0"""),
}
