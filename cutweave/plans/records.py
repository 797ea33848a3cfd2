"""Queries of a run's records: reasons of fallbacks, missing windows, closing records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import records as R
from ..sources import logs as L
from ..sources.fixtures import table
from ..sources.scratch import spread
from . import queueing as Q
from .catalog import query
from .recorded import RESULTS_SQL, results

WINDOWS = 11  # planned windows of a sample; its log has nine at most


@query("map02_reasons_filled", """WITH e AS (SELECT event_id AS id, unnest([
    {'k': 'summary_fallback_used', 'v': CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END}, {'k': 'summary_fallback_reason', 'v': ' '},
    {'k': 'summary_reason', 'v': CASE WHEN event_id % 5 > 0 THEN ' empty ' ELSE '' END}, {'k': 'merge_fallback_used', 'v': CASE WHEN event_id % 3 = 0 THEN 'True' ELSE 'false' END},
    {'k': 'merge_reason', 'v': event_type}, {'k': 'label_fallback_used', 'v': 'true'}, {'k': 'label_fallback_reason', 'v': 'own'}, {'k': 'label_reason', 'v': 'other'}], recursive := true) FROM events),
p AS (SELECT id, CASE WHEN ends_with(k, '_fallback_used') THEN k[1:len(k) - 14] WHEN ends_with(k, '_fallback_reason') THEN k[1:len(k) - 16] ELSE k[1:len(k) - 7] END AS stem, max(v) FILTER (WHERE ends_with(k, '_fallback_used')) AS used,
  max(v) FILTER (WHERE ends_with(k, '_fallback_reason')) AS own, max(v) FILTER (WHERE ends_with(k, '_reason') AND NOT ends_with(k, '_fallback_reason')) AS plain FROM e GROUP BY ALL),
q AS (SELECT *, CASE WHEN lower(used) = 'true' AND trim(coalesce(own, '')) = '' AND trim(coalesce(plain, '')) <> '' THEN trim(plain) ELSE own END AS told FROM p)
SELECT id, stem || '_fallback_used' AS field, used AS value FROM q WHERE used IS NOT NULL UNION ALL SELECT id, stem || '_reason', plain FROM q WHERE plain IS NOT NULL UNION ALL SELECT id, stem || '_fallback_reason', told FROM q WHERE told IS NOT NULL""")
def map02(spark, sf_dir):
    k = F.col("event_id")
    facts = {
        "summary_fallback_used": F.when(k % 2 == 0, "true").otherwise("false"), "summary_fallback_reason": F.lit(" "), "summary_reason": F.when(k % 5 > 0, " empty ").otherwise(""),
        "merge_fallback_used": F.when(k % 3 == 0, "True").otherwise("false"), "merge_reason": F.col("event_type"),
        "label_fallback_used": F.lit("true"), "label_fallback_reason": F.lit("own"), "label_reason": F.lit("other"),
    }
    m = F.create_map(*[x for name, value in facts.items() for x in (F.lit(name), value)])
    # a row takes long and a file holds many rows, so these are dealt to all tasks; each map is made once
    rows = spread(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id").select(k.alias("id"), m.alias("facts"))
    return rows.select("id", F.explode(R.with_reasons(F.col("facts"))).alias("field", "value"))


@query("join03_missing_windows", f"""WITH {RESULTS_SQL}, w AS (SELECT sample_id, window_id, count(*) FILTER (WHERE error IS NULL) AS ok FROM res GROUP BY ALL)
SELECT sample_id, window_id FROM (SELECT DISTINCT sample_id, CAST(x AS INT) AS window_id FROM log, range({WINDOWS}) AS r(x)) ANTI JOIN (SELECT * FROM w WHERE ok >= 2 OR ok = 0) AS d USING (sample_id, window_id)""")
def join03(spark, sf_dir):
    rollup = L.repeat_rollup(results(spark, sf_dir))
    samples = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 64).cast("long").alias("sample_id")).distinct()
    planned = samples.select("sample_id", F.explode(F.sequence(F.lit(0), F.lit(WINDOWS - 1))).alias("window_id"))
    return R.still_missing(planned, rollup.filter("successes >= 2"), ["sample_id", "window_id"], rollup.filter("successes = 0"))


@query("str08_closing_records", f"""SELECT task_id, seq, dispatch_id, '{{}}' AS vlm_json, status AS terminal_error FROM ({Q.ALL_SQL})
WHERE status IN ('timeout_retry_exhausted', 'empty_retry_exhausted')""")
def str08(spark, sf_dir):
    return R.closing_records(Q.str02(spark, sf_dir))
