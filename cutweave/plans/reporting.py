"""Queries of event logs, runtime records and run summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import store
from ..sources.fixtures import table
from .catalog import query

NAMES = {"view": "sample_stage_done", "signup": "artifact_extract_done", "click": "infer_attempt", "error": "result_empty_retry", "purchase": "job_done"}
STAGES = ["windows", "merge", "export"]
EVENTS_SQL = f"""ev AS (SELECT event_id, user_id AS sample_id, CASE WHEN event_id % 10 = 0 THEN 'finalize_done' WHEN event_id % 97 = 0 THEN ' ' ELSE CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items())} END END AS event,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, epoch_us(ts) // 1000 AS ts_unix_ms, {STAGES}[CAST(event_id % 3 + 1 AS INT)] AS stage, CAST(floor(value * 10) AS BIGINT) AS ms, CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN ' ' ELSE 'd1' END AS subset,
  CASE WHEN event_id % 7 > 0 THEN 't' || event_id END AS task_id, CASE WHEN event_id % 11 > 0 THEN event_id % 4 END AS attempt FROM events)"""


def events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    name = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])[F.col("event_type")]
    out = e.select(
        "event_id", F.col("user_id").alias("sample_id"), F.when(F.col("event_id") % 10 == 0, "finalize_done").when(F.col("event_id") % 97 == 0, " ").otherwise(name).alias("event"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_unix_ms"), F.element_at(F.array(*[F.lit(s) for s in STAGES]), (F.col("event_id") % 3 + 1).cast("int")).alias("stage"), F.floor(F.col("value") * 10).cast("long").alias("ms"),
        F.when(F.col("event_id") % 29 == 0, None).when(F.col("event_id") % 31 == 0, " ").otherwise("d1").alias("subset"), F.when(F.col("event_id") % 7 > 0, F.concat(F.lit("t"), "event_id")).alias("task_id"), F.when(F.col("event_id") % 11 > 0, F.col("event_id") % 4).alias("attempt"),
    )
    return out.withColumn("elapsed_ms", F.col("ms")).withColumns({m: F.when(F.col("event").isin(*[n for n, fs in M.REQUIRED.items() if m in fs]), F.col("ms")) for m in M.METRICS})


@query("agg11_sample_timing", f"""WITH {EVENTS_SQL} SELECT sample_id, arg_min(ts, ts_unix_ms) AS first_at, arg_max(ts, ts_unix_ms) AS last_at, count(*) AS events, CAST(coalesce(sum(ms) FILTER (WHERE event = 'artifact_extract_done'), 0) AS BIGINT) AS extract_total,
  CAST(coalesce(sum(ms) FILTER (WHERE event = 'infer_attempt'), 0) AS BIGINT) AS infer_total, CAST(coalesce(sum(ms) FILTER (WHERE event IN ('job_done', 'result_empty_retry')), 0) AS BIGINT) AS submit_total, CAST(coalesce(sum(ms) FILTER (WHERE event = 'finalize_done'), 0) AS BIGINT) AS finalize_total,
  max(ts_unix_ms) - min(ts_unix_ms) AS total_elapsed_ms FROM ev WHERE trim(event) <> '' GROUP BY ALL""")
def agg11(spark, sf_dir):
    return M.timing(events(spark, sf_dir))


@query("agg11_stage_times", f"WITH {EVENTS_SQL} SELECT sample_id, stage, CAST(sum(ms) AS BIGINT) AS elapsed_ms FROM ev WHERE event = 'sample_stage_done' GROUP BY ALL")
def agg11_stages(spark, sf_dir):
    return M.stage_times(events(spark, sf_dir))


@query("agg11_event_counts", f"WITH {EVENTS_SQL} SELECT sample_id, event, count(*) AS n FROM ev WHERE trim(event) <> '' GROUP BY ALL")
def agg11_counts(spark, sf_dir):
    return M.event_counts(events(spark, sf_dir))


METRIC_SQL = " UNION ALL ".join(f"SELECT '{m}' AS metric, ms FROM ev WHERE event IN ({', '.join(repr(n) for n, fs in M.REQUIRED.items() if m in fs)})" for m in M.METRICS)


@query("agg18_latencies", f"WITH {EVENTS_SQL}, m AS ({METRIC_SQL}) SELECT metric, count(*) AS n, CAST(sum(ms) AS BIGINT) AS total, quantile_cont(ms, 0.5) AS p50, round(quantile_cont(ms, 0.95), 6) AS p95, max(ms) AS most FROM m GROUP BY ALL")
def agg18(spark, sf_dir):
    return M.latencies(events(spark, sf_dir)).withColumn("p95", F.round("p95", 6))


#: Fields of contracts: a field is NULL in one event of so many, and an identifier blank in another.
FIELDS = {f: 7 + i for i, f in enumerate(sorted({f for fs in M.REQUIRED.values() for f in fs}))}
KINDS_OF_EVENT = [*sorted(M.REQUIRED), "of_no_contract"]


def field_sql(field: str) -> str:
    value = f"CASE WHEN (event_id + user_id) % {FIELDS[field] + 4} = 0 THEN ' ' ELSE event_type || user_id END" if field in M.IDENTIFIERS else "event_id"
    return f"CASE WHEN event_id % {FIELDS[field]} <> 0 THEN {value} END AS {field}"


CONTRACT_SQL = f"""ce AS (SELECT event_id, {KINDS_OF_EVENT}[CAST(event_id % {len(KINDS_OF_EVENT)} + 1 AS INT)] AS event, {', '.join(field_sql(f) for f in FIELDS)} FROM events),
need AS (SELECT * FROM (VALUES {', '.join(f"('{e}', '{f}')" for e, fs in M.REQUIRED.items() for f in fs)}) AS n(event, field)),
told AS (SELECT event_id, event, unnest([{', '.join(f"struct_pack(field := '{f}', value := CAST({f} AS VARCHAR))" for f in FIELDS)}], recursive := true) FROM ce)"""


def contract_events(spark, sf_dir):
    """Events of all contracts and one without, with all their fields."""
    n, u = F.col("event_id"), F.col("user_id")

    def value(field):
        told = F.when((n + u) % (FIELDS[field] + 4) == 0, " ").otherwise(F.concat("event_type", u.cast("string"))) if field in M.IDENTIFIERS else n
        return F.when(n % FIELDS[field] != 0, told).alias(field)

    name = F.element_at(F.array(*[F.lit(k) for k in KINDS_OF_EVENT]), (n % len(KINDS_OF_EVENT) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", name.alias("event"), *[value(f) for f in FIELDS])


@query("val06_contract_violations", f"""WITH {CONTRACT_SQL} SELECT event_id, string_agg(field, ',' ORDER BY field) AS missing FROM told JOIN need USING (event, field)
WHERE value IS NULL OR (field IN ({', '.join(repr(f) for f in M.IDENTIFIERS)}) AND trim(value) = '') GROUP BY event_id""")
def val06(spark, sf_dir):
    return M.contract_violations(contract_events(spark, sf_dir))


@query("snk11_checked_lines", f"""WITH {CONTRACT_SQL}, bad AS (SELECT DISTINCT event_id FROM told JOIN need USING (event, field) WHERE value IS NULL OR (field IN ({', '.join(repr(f) for f in M.IDENTIFIERS)}) AND trim(value) = '')),
parts AS (SELECT event_id, field, CASE WHEN field IN ({', '.join(repr(f) for f in M.IDENTIFIERS)}) THEN '"' || value || '"' ELSE value END AS shown FROM told WHERE value IS NOT NULL UNION ALL SELECT event_id, 'event', '"' || event || '"' FROM ce)
SELECT event_id, '{{' || string_agg('"' || field || '":' || shown, ',' ORDER BY field) || '}}' AS line FROM parts WHERE event_id NOT IN (SELECT event_id FROM bad) GROUP BY event_id""")
def snk11(spark, sf_dir):
    return store.checked_lines(contract_events(spark, sf_dir))[0]


@query("agg18_repeats", f"""WITH {CONTRACT_SQL}, r AS (SELECT subset, count(*) FILTER (WHERE event = 'result_empty_retry') AS e, count(*) FILTER (WHERE event = 'result_timeout_retry') AS t, count(*) FILTER (WHERE event = 'fallback_applied') AS f FROM ce GROUP BY subset)
SELECT subset, e AS empty_retries, t AS timeout_retries, e + t AS retries, f AS fallbacks FROM r WHERE e + t + f > 0""")
def agg18b(spark, sf_dir):
    return M.repeats(contract_events(spark, sf_dir))


RECORDS_SQL = """st AS (SELECT o_orderkey AS sample_id, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE '' END AS ts, o_orderkey % 3 <> 0 AS ex, o_orderkey % 4 AS done, o_orderkey % 9 - 2 AS tr, o_orderkey % 5 - 1 AS er, o_orderkey % 7 - 3 AS dc,
  CASE o_orderkey % 6 WHEN 0 THEN ' applied ' WHEN 1 THEN 'partial_failure' WHEN 2 THEN NULL ELSE '' END AS reason, CASE WHEN o_orderkey % 8 = 1 THEN false WHEN o_orderkey % 8 = 2 THEN true END AS enabled, CASE WHEN o_orderkey % 10 = 3 THEN true END AS attempted,
  CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'export_failed' ELSE 'step_a_exception' END END AS failure FROM orders WHERE o_orderkey % 17 > 0),
rec AS (SELECT sample_id, CASE WHEN ts = '' THEN 'unknown' ELSE ts END AS terminal_state, CASE WHEN ex THEN ['windows', 'merge', 'export'] ELSE ['windows', 'merge'] END AS required, ['windows', 'merge', 'export'][1:done] AS completed, greatest(0, tr) AS total_retries, greatest(0, er) AS empty_retries, 0 AS timeout_retries,
  CASE WHEN dc > 0 THEN dc WHEN ts <> '' THEN greatest(0, tr) + 1 ELSE 0 END AS dispatches, CASE WHEN trim(reason) = 'applied' THEN 'applied' WHEN failure = 'export_failed' OR reason = 'partial_failure' THEN 'failed' WHEN NOT coalesce(enabled, ex) THEN 'disabled' WHEN ex AND NOT coalesce(attempted, false) THEN 'not_attempted' WHEN NOT ex THEN 'not_required' ELSE 'unknown' END AS export_status, coalesce(failure, '') AS failure_reason FROM st)"""


def records(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders").filter("o_orderkey % 17 > 0"), F.col("o_orderkey")
    names = F.array(F.lit(" windows"), F.lit("merge"), F.lit("export"))
    state = o.select(
        k.alias("sample_id"), F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "failed").otherwise("").alias("terminal_state"), F.when(k % 3 != 0, F.array(F.lit("windows"), F.lit("merge "), F.lit("export"), F.lit("windows"), F.lit(""))).otherwise(F.array(F.lit("windows"), F.lit("merge"))).alias("required"),
        F.slice(names, 1, (k % 4).cast("int")).alias("completed"), (k % 9 - 2).alias("total_retries"), (k % 5 - 1).cast("string").alias("empty_retries"), F.lit("none").alias("timeout_retries"), (k % 7 - 3).alias("dispatches"),
        F.when(k % 6 == 0, " applied ").when(k % 6 == 1, "partial_failure").when(k % 6 == 2, None).otherwise("").alias("export_reason"), F.when(k % 8 == 1, False).when(k % 8 == 2, True).alias("export_enabled"), F.when(k % 10 == 3, True).alias("export_attempted"),
        F.when(F.col("o_orderstatus") == "O", F.when(k % 2 == 0, "export_failed").otherwise("step_a_exception")).alias("failure_reason"),
    )
    return M.runtime_records(state)


@query("agg13_runtime_records", f"WITH {RECORDS_SQL} SELECT * REPLACE (array_to_string(required, ' ') AS required, array_to_string(completed, ' ') AS completed), array_to_string(list_filter(required, lambda s: NOT list_contains(completed, s)), ' ') AS pending FROM rec")
def agg13(spark, sf_dir):
    return records(spark, sf_dir).withColumns({c: F.array_join(c, " ") for c in ("required", "completed", "pending")})


@query("agg12_run_summary", f"""WITH {RECORDS_SQL}, j AS (SELECT o_orderkey, rec.* FROM orders LEFT JOIN rec ON sample_id = o_orderkey),
f AS (SELECT 'state' AS section, coalesce(terminal_state, 'pending') AS name, 1 AS n FROM j UNION ALL SELECT 'export', export_status, 1 FROM j WHERE export_status IS NOT NULL UNION ALL SELECT 'failure', failure_reason, 1 FROM j WHERE failure_reason <> ''
  UNION ALL SELECT 'retry', 'total_retries', coalesce(total_retries, 0) FROM j UNION ALL SELECT 'retry', 'empty_retries', coalesce(empty_retries, 0) FROM j UNION ALL SELECT 'retry', 'timeout_retries', 0 FROM j UNION ALL SELECT 'retry', 'dispatches', coalesce(dispatches, 0) FROM j
  UNION ALL SELECT 'stage_completed', unnest(list_filter(required, lambda s: list_contains(completed, s))), 1 FROM j UNION ALL SELECT 'stage_missing', unnest(list_filter(required, lambda s: NOT list_contains(completed, s))), 1 FROM j)
SELECT section, name, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY ALL""")
def agg12(spark, sf_dir):
    return M.run_summary(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id")), records(spark, sf_dir))


@query("agg14_dispatches", "SELECT user_id AS sample_id, count(*) AS dispatches, count(DISTINCT event_id % 40) AS tasks FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL")
def agg14(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("event_type IN ('click', 'view')").groupBy(F.col("user_id").alias("sample_id")).agg(F.count("*").alias("dispatches"), F.count_distinct(F.col("event_id") % 40).alias("tasks"))


@query("agg15_retry_summary", "WITH l AS (SELECT user_id AS sample_id, count(*) FILTER (WHERE event_type = 'error') AS live, max(CAST(floor(value) AS BIGINT)) % 13 AS kept FROM events GROUP BY ALL) SELECT sample_id, greatest(live, kept) AS total_retries, greatest(live, kept) + 1 AS dispatches FROM l")
def agg15(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("sample_id")).agg(F.count_if(F.col("event_type") == "error").alias("live"), (F.max(F.floor("value")) % 13).alias("kept"))
    return rows.select("sample_id", F.greatest("live", "kept").alias("total_retries"), (F.greatest("live", "kept") + 1).alias("dispatches"))


@query("agg17_exit_code", "SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS failed, CAST(count(*) FILTER (WHERE o_orderstatus = 'O') > 0 AS INT) AS exit_code FROM orders")
def agg17(spark, sf_dir):
    failed = F.count_if(F.col("o_orderstatus") == "O")
    return table(spark, sf_dir, "orders").agg(failed.alias("failed"), (failed > 0).cast("int").alias("exit_code"))


@query("agg19_export_outcomes", """WITH p AS (SELECT l_orderkey AS sample_id, count(*) FILTER (WHERE l_returnflag <> 'R') AS written, count(*) FILTER (WHERE l_returnflag = 'R') AS errors FROM lineitem GROUP BY ALL)
SELECT sample_id, written, errors, CASE WHEN errors = 0 THEN 'applied' WHEN written > 0 THEN 'partial_failure' ELSE 'failed' END AS outcome FROM p""")
def agg19(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sample_id")).agg(F.count_if(F.col("l_returnflag") != "R").alias("written"), F.count_if(F.col("l_returnflag") == "R").alias("errors"))
    return p.withColumn("outcome", F.when(F.col("errors") == 0, "applied").when(F.col("written") > 0, "partial_failure").otherwise("failed"))


@query("agg20_median_duration", "WITH d AS (SELECT l_orderkey AS sample_id, median(l_quantity * 30) AS frames, count(*) AS n FROM lineitem GROUP BY ALL) SELECT * FROM d")
def agg20(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sample_id")).agg(F.median(F.col("l_quantity") * 30).alias("frames"), F.count("*").alias("n"))


@query("mth03_counts", "SELECT event_id, greatest(0, coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id % 9 - 4 AS VARCHAR) END AS BIGINT), 0)) AS n FROM events")
def mth03(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise((F.col("event_id") % 9 - 4).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", M.count_of(text).alias("n"))


@query("txt31_timestamps", "SELECT event_id, epoch_us(ts) // 1000 AS ts_unix_ms, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S') AS ts FROM events")
def txt31(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", ms.alias("ts_unix_ms"), F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss").alias("ts"))
