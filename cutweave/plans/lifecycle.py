"""Queries of the life of a sample in a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle as Y
from ..sources.fixtures import table
from .catalog import query

STAGES = ["stage1_segments", "stage2_text", "export"]
STAGES_SQL = str(STAGES)
# Samples are orders, subsets their priorities; what a sample has done, wants and failed by follows from its key.
RUN_SQL = f"""run AS (SELECT o_orderpriority AS subset, o_orderkey AS sample_id, {STAGES_SQL}[1:CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 3 END] AS required,
  {STAGES_SQL}[1:CAST(o_orderkey % 4 AS INT)] AS completed, CASE o_orderkey % 10 WHEN 7 THEN ' export_failed ' WHEN 8 THEN ' ' END AS failure_reason, o_orderstatus = 'F' AS was_done FROM orders)"""
OUTCOME_SQL = f"""{RUN_SQL}, o AS (SELECT *, coalesce(trim(failure_reason), '') <> '' AS failed, list_filter(required, lambda s: NOT list_contains(completed, s)) AS missing FROM run),
outcomes AS (SELECT subset, sample_id, CASE WHEN failed THEN 'failed' WHEN len(missing) = 0 THEN 'done' ELSE 'refused' END AS outcome, CASE WHEN failed THEN '' ELSE array_to_string(missing, ', ') END AS missing, NOT failed AND len(missing) = 0 AND was_done AS already_done FROM o)"""
MARKED_SQL = f"""{OUTCOME_SQL}, marked AS (SELECT subset, sample_id, outcome AS marker FROM outcomes WHERE outcome <> 'refused'
  UNION ALL SELECT subset, sample_id, 'done' FROM outcomes JOIN run USING (subset, sample_id) WHERE outcome = 'refused' AND was_done)"""


def run(spark, sf_dir):
    k, all_ = F.col("o_orderkey"), F.array(*[F.lit(s) for s in STAGES])
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("subset"), k.alias("sample_id"), F.slice(all_, 1, F.when(k % 3 == 0, 2).otherwise(3)).alias("required"), F.slice(all_, 1, (k % 4).cast("int")).alias("completed"),
        F.when(k % 10 == 7, " export_failed ").when(k % 10 == 8, " ").alias("failure_reason"), (F.col("o_orderstatus") == "F").alias("was_done"),
    )


def marked(spark, sf_dir):
    r = run(spark, sf_dir)
    return Y.after_commit(r.filter("was_done").select("subset", "sample_id", F.lit("done").alias("marker")), Y.finished(r))


@query("snk04_commit_outcomes", f"WITH {OUTCOME_SQL} SELECT * FROM outcomes")
def snk04(spark, sf_dir):
    return Y.finished(run(spark, sf_dir))


@query("snk05_markers_after_commit", f"WITH {MARKED_SQL} SELECT * FROM marked")
def snk05(spark, sf_dir):
    return marked(spark, sf_dir)


# Jobs in the queue: lines of an order, but for those that were returned.
@query("str09_open_jobs", f"WITH {OUTCOME_SQL}, q AS (SELECT o_orderpriority AS subset, l_orderkey AS sample_id, l_linenumber AS job FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R') SELECT q.* FROM q JOIN outcomes USING (subset, sample_id) WHERE outcome <> 'failed'")
def str09(spark, sf_dir):
    return Y.open_jobs(queue(spark, sf_dir), Y.finished(run(spark, sf_dir)).filter("outcome = 'failed'"))


def queue(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("subset"), F.col("o_orderkey").alias("sample_id"))
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("sample_id"), F.col("l_linenumber").alias("job"))
    return li.join(o, "sample_id").select("subset", "sample_id", "job")


@query("str11_sample_states", f"""WITH {MARKED_SQL}, j AS (SELECT DISTINCT l_orderkey AS sample_id FROM lineitem WHERE l_returnflag <> 'R')
SELECT run.subset, run.sample_id, CASE WHEN marker = 'failed' THEN 4 WHEN marker = 'done' THEN 3 WHEN run.sample_id % 2 = 0 AND j.sample_id IS NULL THEN 2 ELSE 0 END AS state
FROM run LEFT JOIN marked USING (subset, sample_id) LEFT JOIN j ON j.sample_id = run.sample_id""")
def str11(spark, sf_dir):
    samples = run(spark, sf_dir).select("subset", "sample_id", (F.col("sample_id") % 2 == 0).alias("planned"))
    return Y.sample_states(samples, marked(spark, sf_dir), queue(spark, sf_dir))


DIAGNOSTICS = "CASE WHEN sample_id % 5 = 0 THEN MAP {'export_reason': 'kept'} ELSE MAP {'merge': 'x'} END"


def diagnostics():
    return F.when(F.col("sample_id") % 5 == 0, F.create_map(F.lit("export_reason"), F.lit("kept"))).otherwise(F.create_map(F.lit("merge"), F.lit("x")))


@query("str12_reconciled", f"""WITH {MARKED_SQL}, m AS (SELECT marked.*, run.required AS req, completed, failure_reason, CASE WHEN sample_id % 7 < 3 THEN marker WHEN sample_id % 7 < 5 THEN 'running' END AS known FROM marked JOIN run USING (subset, sample_id)),
s AS (SELECT *, CASE WHEN marker = 'failed' THEN {STAGES_SQL}[1:2] WHEN sample_id % 6 = 0 THEN {STAGES_SQL} ELSE req END AS required FROM m WHERE known IS DISTINCT FROM marker),
c AS (SELECT *, CASE WHEN marker = 'failed' THEN [] ELSE required END AS full_done FROM s)
SELECT subset, sample_id, marker AS terminal_state, array_to_string(required, ' ') AS required, array_to_string(full_done, ' ') AS completed, CASE WHEN marker = 'failed' THEN trim(failure_reason) ELSE '' END AS failure_reason,
  CASE WHEN marker = 'failed' THEN '' WHEN sample_id % 5 = 0 THEN 'kept' WHEN list_contains(required, 'export') THEN 'applied' ELSE '' END AS export_reason FROM c""")
def str12(spark, sf_dir):
    m, r = marked(spark, sf_dir), run(spark, sf_dir)
    flags = m.select("subset", "sample_id", (F.col("marker") == "done").alias("done"), (F.col("marker") == "failed").alias("failed"))
    runtimes = m.filter("sample_id % 7 < 5").select("subset", "sample_id", F.when(F.col("sample_id") % 7 < 3, F.col("marker")).otherwise("running").alias("terminal_state"))
    payloads = r.select("subset", "sample_id", diagnostics().alias("diagnostics"), F.when(F.col("sample_id") % 6 == 0, F.array(*[F.lit(s) for s in STAGES])).otherwise(F.col("required")).alias("required"), F.lit(None).cast("array<string>").alias("completed"))
    reports = r.filter("failure_reason IS NOT NULL").select("subset", "sample_id", F.col("failure_reason").alias("reason"), F.lit(None).cast("array<string>").alias("required"), F.lit(None).cast("array<string>").alias("completed"))
    stages = r.select("subset").distinct().withColumn("required", F.array(*[F.lit(s) for s in STAGES[:2]]))
    out = Y.reconciled(flags, runtimes, payloads, reports, stages)
    reason = F.coalesce(F.try_element_at("diagnostics", F.lit("export_reason")), F.lit(""))
    return out.select("subset", "sample_id", "terminal_state", F.array_join("required", " ").alias("required"), F.array_join("completed", " ").alias("completed"), "failure_reason", reason.alias("export_reason"))


@query("rtm01_retry_counters", """WITH s AS (SELECT o_orderpriority AS subset, o_orderkey AS sample_id, o_orderkey % 5 AS t, o_orderkey % 3 AS e, o_orderkey % 2 AS l FROM orders WHERE o_orderkey % 4 > 0),
n AS (SELECT o_orderpriority AS subset, o_orderkey AS sample_id, count(*) FILTER (WHERE l_returnflag = 'R') AS e, count(*) FILTER (WHERE l_returnflag = 'A') AS l FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N' GROUP BY ALL)
SELECT subset, sample_id, CASE WHEN coalesce(n.e + n.l, 0) > 0 THEN coalesce(s.e, 0) + coalesce(s.l, 0) + n.e + n.l ELSE coalesce(s.t, 0) END AS total_retries, coalesce(s.e, 0) + coalesce(n.e, 0) AS empty_retries, coalesce(s.l, 0) + coalesce(n.l, 0) AS timeout_retries, coalesce(s.t, 0) AS dispatches
FROM s FULL JOIN n USING (subset, sample_id)""")
def rtm01(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderpriority": "subset", "o_orderkey": "sample_id"}), F.col("sample_id")
    stored = o.filter("sample_id % 4 > 0").select("subset", "sample_id", (k % 5).alias("total_retries"), (k % 3).alias("empty_retries"), (k % 2).alias("timeout_retries"), (k % 5).alias("dispatches"))
    field = F.when(F.col("l_returnflag") == "R", "empty_retries").otherwise("timeout_retries")
    retries = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("sample_id"), field.alias("field")).join(o.select("subset", "sample_id"), "sample_id")
    return Y.retry_counters(stored, retries)


@query("rtm03_export_defaults", f"""WITH {RUN_SQL} SELECT sample_id, CASE WHEN sample_id % 5 = 0 THEN 'kept' WHEN list_contains(required, 'export') AND list_contains(completed, 'export') THEN 'applied' ELSE '' END AS export_reason FROM run""")
def rtm03(spark, sf_dir):
    m = Y.with_export_defaults(diagnostics(), F.col("required"), F.col("completed"))
    return run(spark, sf_dir).select("sample_id", F.coalesce(F.try_element_at(m, F.lit("export_reason")), F.lit("")).alias("export_reason"))


@query("rtm04_required_stages", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'a b' ELSE concat_ws(' ', 'stage1_segments', CASE WHEN o_orderkey % 2 = 0 THEN 'stage2_text' END, CASE WHEN o_orderkey % 5 = 0 THEN 'export' END) END AS stages FROM orders")
def rtm04(spark, sf_dir):
    k = F.col("o_orderkey")
    stated = F.when(k % 3 == 0, F.array(F.lit(" a "), F.lit("  "), F.lit("b")))
    return table(spark, sf_dir, "orders").select(k.alias("id"), F.array_join(Y.required_stages(stated, k % 2 == 0, k % 5 == 0), " ").alias("stages"))


@query("rtm06_structured_events", """SELECT CASE WHEN event_id % 9 = 0 THEN ' ' ELSE 's' END AS subset, CAST(user_id AS VARCHAR) AS sample_id, event_type AS event, CASE WHEN event_id % 4 > 0 THEN CAST(event_id % 4 AS VARCHAR) END AS attempt, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms
FROM events WHERE event_id % 9 > 0 AND event_id % 8 > 0""")
def rtm06(spark, sf_dir):
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select(F.when(k % 9 == 0, " ").otherwise("s").alias("subset"), F.when(k % 8 > 0, F.col("user_id")).alias("sample_id"), F.col("event_type").alias("event"), F.when(k % 4 > 0, k % 4).alias("attempt"), F.col("ts").cast("timestamp").alias("at"))
    lines = Y.structured_events(e, F.col("at"))
    of = lambda p: F.get_json_object("line", p)
    return lines.select("subset", F.col("sample_id").cast("string").alias("sample_id"), of("$.event").alias("event"), of("$.attempt").alias("attempt"), of("$.ts_unix_ms").alias("ms"))





@query("man01_manifest_actions", """WITH r AS (SELECT c_custkey AS subset, c_custkey % 4 = 0 AS absent, c_custkey % 7 = 0 AND c_custkey % 4 > 0 AS broken, c_custkey % 5 = 0 AS changed, c_custkey % 3 = 0 AS more, c_custkey % 2 = 0 AS nonempty, c_nationkey % 2 = 0 AS force FROM customer),
d AS (SELECT *, CASE WHEN absent THEN CASE WHEN nonempty AND subset % 8 = 0 THEN 'missing_manifest' ELSE '' END WHEN broken THEN 'manifest_schema' ELSE concat_ws(',', CASE WHEN changed THEN 'config_hash' END, CASE WHEN more THEN 'required_stages' END) END AS mismatches FROM r)
SELECT subset, CASE WHEN mismatches <> '' AND NOT force THEN 'refused' WHEN absent AND mismatches <> '' THEN 'force_resume_rebuilt_missing_manifest' WHEN absent THEN 'created_fresh_manifest'
  WHEN mismatches <> '' THEN 'force_resume_overrode_identity_mismatch' ELSE 'validated_existing_manifest' END AS action, mismatches FROM d""")
def man01(spark, sf_dir):
    k = F.col("c_custkey")
    fields = lambda changed: F.struct(*[(F.when(k % 5 == 0, "other").otherwise("v") if changed and n == "config_hash" else F.when(k % 3 == 0, "a b").otherwise("a") if changed and n == "required_stages" else F.lit("a" if n == "required_stages" else "v")).alias(n) for n in Y.IDENTITY])
    absent, broken = k % 4 == 0, (k % 7 == 0) & (k % 4 > 0)
    runs = table(spark, sf_dir, "customer").select(k.alias("subset"), fields(False).alias("current"), F.when(~absent & ~broken, fields(True)).alias("existing"), F.when(~absent, ~broken).alias("readable"), (k % 8 == 0).alias("nonempty"), (F.col("c_nationkey") % 2 == 0).alias("force"))
    return Y.manifest_actions(runs, F.col("force"))


@query("str13_reused_artifacts", """WITH j AS (SELECT event_id AS task, user_id AS sample, event_type AS kind, CASE WHEN event_id % 6 > 0 THEN event_id % 4 END AS win FROM events),
f AS (SELECT *, min(task) OVER (PARTITION BY sample, kind, win) AS first FROM j) SELECT task, CASE WHEN win IS NULL THEN task ELSE first END AS producer, win IS NOT NULL AND task > first AS reused FROM f""")
def str13(spark, sf_dir):
    k = F.col("event_id")
    jobs = table(spark, sf_dir, "events").select(k.alias("task"), F.col("user_id").alias("sample"), F.col("event_type").alias("kind"), F.when(k % 6 > 0, k % 4).alias("win"))
    return Y.first_of_group(jobs, ["sample", "kind", "win"], "task", "task").select("task", "producer", "reused")
