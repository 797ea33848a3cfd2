"""Queries of the work queue and of event streams, replayed in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.fixtures import table
from ..streaming import queue as Q
from .catalog import query

#: Events of a task and seconds between them: tasks grow in number with the events, not in length.
EACH, APART = 64, 37
LOG_SQL = f"""q AS (SELECT 't' || event_id // {EACH} AS task_id, event_id AS seq, CASE event_id % {EACH} % 3 WHEN 0 THEN 'dispatch' WHEN 1 THEN 'result' ELSE 'tick' END AS kind,
  event_id % {EACH} AS round, CAST(event_id * {APART} AS DOUBLE) AS moment, event_type FROM events)"""


def log(spark, sf_dir):
    e, turn = table(spark, sf_dir, "events"), F.col("event_id") % EACH
    kind = F.element_at(F.array(F.lit("dispatch"), F.lit("result"), F.lit("tick")), (turn % 3 + 1).cast("int"))
    name = F.concat(F.lit("d"), (F.floor(turn / 3) + 1 - (F.col("event_type") == "signup").cast("long")).cast("string"))
    return e.select(F.concat(F.lit("t"), F.floor(F.col("event_id") / EACH).cast("string")).alias("task_id"), F.col("event_id").alias("seq"), kind.alias("kind"), F.when(kind == "result", name).alias("dispatch_id"), (F.col("event_id") * APART).cast("double").alias("at"), (F.col("event_type") != "purchase").alias("empty"))


STATUS_SQL = f"""WITH RECURSIVE {LOG_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY seq) AS k, event_type <> 'purchase' AS vacant,
    CASE WHEN kind = 'result' THEN 'd' || (round // 3 + 1 - CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) END AS given FROM q),
r AS (SELECT DISTINCT task_id, 0::BIGINT AS k, NULL::BIGINT AS seq, NULL::VARCHAR AS kind, NULL::VARCHAR AS dispatch_id, NULL::VARCHAR AS status,
    NULL::VARCHAR AS out_now, 0::DOUBLE AS since, NULL::VARCHAR AS accepted, 0 AS dispatches, 0 AS empties, 0 AS timeouts, false AS closed FROM o
  UNION ALL SELECT task_id, k, seq, kind,
    CASE WHEN status = 'dispatched' THEN 'd' || (dispatches + 1) WHEN kind = 'tick' THEN out_now ELSE given END,
    status,
    CASE WHEN status = 'dispatched' THEN 'd' || (dispatches + 1) WHEN status IN ('received', 'retry_triggered', 'empty_retry_exhausted', 'timeout_requeued', 'timeout_retry_exhausted') THEN NULL ELSE out_now END,
    CASE WHEN status = 'dispatched' THEN moment ELSE since END,
    CASE WHEN status = 'received' THEN given ELSE accepted END,
    dispatches + CASE WHEN status = 'dispatched' THEN 1 ELSE 0 END,
    empties + CASE WHEN status IN ('retry_triggered', 'empty_retry_exhausted') THEN 1 ELSE 0 END,
    timeouts + CASE WHEN status IN ('timeout_requeued', 'timeout_retry_exhausted') THEN 1 ELSE 0 END,
    closed OR status IN ('empty_retry_exhausted', 'timeout_retry_exhausted')
  FROM (SELECT r.task_id, o.k, o.seq, o.kind, o.given, o.moment, out_now, since, accepted, dispatches, empties, timeouts, closed,
      CASE WHEN o.kind = 'dispatch' THEN CASE WHEN closed OR accepted IS NOT NULL OR out_now IS NOT NULL THEN 'refused' ELSE 'dispatched' END
        WHEN o.kind = 'tick' THEN CASE WHEN out_now IS NULL THEN 'idle' WHEN moment - since <= 50 THEN 'waiting' WHEN timeouts + 1 > 3 THEN 'timeout_retry_exhausted' ELSE 'timeout_requeued' END
        WHEN given = accepted THEN 'already_received' WHEN out_now IS NULL OR given <> out_now THEN 'stale_ignored'
        WHEN NOT vacant THEN 'received' WHEN empties + 1 > 5 THEN 'empty_retry_exhausted' ELSE 'retry_triggered' END AS status
    FROM r JOIN o ON o.task_id = r.task_id AND o.k = r.k + 1))
"""
ALL_SQL = f"{STATUS_SQL} SELECT task_id, seq, kind, dispatch_id, status FROM r WHERE k > 0"
LIMITS = {"timeout": 50.0, "retries": 3, "empty_retries": 5}


@query("str02_ingest_status", ALL_SQL)
def str02(spark, sf_dir):
    return Q.replay(log(spark, sf_dir), **LIMITS)


@query("str03_first_results", f"WITH {LOG_SQL}, g AS (SELECT *, 'd' || (round // 3 + 1 - CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS dispatch_id FROM q WHERE kind = 'result') SELECT task_id, dispatch_id, seq, event_type <> 'purchase' AS empty FROM g QUALIFY row_number() OVER (PARTITION BY task_id, dispatch_id ORDER BY seq) = 1")
def str03(spark, sf_dir):
    return Q.first_of_each(log(spark, sf_dir).filter("kind = 'result'")).select("task_id", "dispatch_id", "seq", "empty")


@query("str05_overdue", f"""{STATUS_SQL}, s AS (SELECT r.*, CAST(seq * {APART} AS DOUBLE) AS moment FROM r WHERE k > 0),
e AS (SELECT task_id, dispatch_id, min(struct_pack(seq := seq, moment := moment, status := status)) AS f FROM s WHERE status IN ('received', 'retry_triggered', 'empty_retry_exhausted', 'timeout_requeued', 'timeout_retry_exhausted') GROUP BY ALL)
SELECT s.task_id, s.dispatch_id, s.moment AS at, e.f.moment AS ended_at, e.f.status AS ended FROM s LEFT JOIN e ON s.task_id = e.task_id AND s.dispatch_id = e.dispatch_id
WHERE s.status = 'dispatched' AND coalesce(e.f.moment, (SELECT max(moment) FROM s)) - s.moment > 36""")
def str05(spark, sf_dir):
    told = log(spark, sf_dir)
    return Q.overdue(Q.replay(told, **LIMITS).join(told.select("task_id", "seq", "at"), ["task_id", "seq"]), 36.0)


@query("str01_dispatch_ids", f"{STATUS_SQL} SELECT task_id, seq, dispatch_id FROM r WHERE status = 'dispatched'")
def str01(spark, sf_dir):
    return Q.replay(log(spark, sf_dir), **LIMITS).filter("status = 'dispatched'").select("task_id", "seq", "dispatch_id")


#: Two entries (of a user's task) to three requests, so that some find nothing; eight moments share a time.
FIFO_SQL = """x AS (SELECT event_id // 8 AS moment, CASE WHEN event_id % 5 < 2 THEN 0 ELSE 1 END AS asks, CASE WHEN event_id % 5 < 2 THEN 't' || user_id ELSE 'r' || event_id END AS name FROM events)"""


@query("str06_next_jobs", f"""WITH RECURSIVE {FIFO_SQL}, o AS (SELECT *, row_number() OVER (ORDER BY moment, asks, name) AS n, sum(1 - asks) OVER (ORDER BY moment, asks, name ROWS UNBOUNDED PRECEDING) AS there FROM x),
q AS (SELECT n, asks, there, row_number() OVER (ORDER BY n) AS j, name FROM o WHERE asks = 1),
r AS (SELECT 0::BIGINT AS j, 0::BIGINT AS taken, NULL::BIGINT AS mine, NULL::VARCHAR AS request_id
  UNION ALL SELECT q.j, r.taken + CASE WHEN q.there > r.taken THEN 1 ELSE 0 END, CASE WHEN q.there > r.taken THEN r.taken + 1 END, q.name FROM r JOIN q ON q.j = r.j + 1),
e AS (SELECT there AS k, name AS task_id FROM o WHERE asks = 0),
m AS (SELECT request_id, task_id, mine, row_number() OVER (PARTITION BY task_id ORDER BY mine) AS turn FROM r LEFT JOIN e ON e.k = r.mine WHERE request_id IS NOT NULL)
SELECT request_id, task_id, CASE WHEN task_id IS NOT NULL THEN 'd' || turn END AS dispatch_id FROM m""")
def str06(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    at, comes = F.floor(F.col("event_id") / 8).alias("at"), F.col("event_id") % 5 < 2
    entries = e.filter(comes).select(at, F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("task_id"))
    return Q.served(entries, e.filter(~comes).select(at, F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id")))


@query("str10_stage_timers", "SELECT user_id AS sample_id, event_id % 3 AS stage, greatest(0, max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) AS elapsed_ms FROM events GROUP BY ALL")
def str10(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("sample_id"), (F.col("event_id") % 3).alias("stage")).agg(F.greatest(F.lit(0).cast("long"), F.max(ms) - F.min(ms)).alias("elapsed_ms"))


@query("str_event_rates", "SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type AS event, count(*) AS n FROM events GROUP BY ALL")
def rates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("event"))
    return Q.event_rates(e).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("str_sessions", """WITH o AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL '6 hours' THEN 1 ELSE 0 END AS new FROM events))
SELECT user_id AS sample_id, epoch_us(min(ts)) // 1000 AS first_ms, epoch_us(max(ts)) // 1000 AS last_ms, count(*) AS n FROM o GROUP BY user_id, s""")
def sess(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("sample_id"))
    return Q.sessions(e, "6 hours").select("sample_id", F.unix_millis("first").alias("first_ms"), F.unix_millis("last").alias("last_ms"), "n")
