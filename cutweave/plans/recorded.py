"""Queries of recorded results: compacted logs, checked payloads, repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import logs as L
from ..sources.fixtures import table
from .catalog import query

# Payloads by event_id modulo 8: usable, one string, cut off, not ascending, a recorded error, beyond the last frame, no transitions, a blank text.
PAYLOADS = ['{"thought":"t","transitions":[2,5],"instructions":["pick up","stir ","place"]}', '{"instructions":" only one "}', None, '{"transitions":[5,2],"instructions":["a","b","c"]}', "{}", '{"transitions":[3,30],"instructions":["a","b","c"]}', '{"thought":null,"transitions":null,"instructions":["rest"]}', '{"transitions":[4],"instructions":["a"," "]}']


def logged(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("k", (F.col("event_id") % 8).cast("int"))
    body = F.element_at(F.array(*[F.lit(p) if p else F.lit("{") for p in PAYLOADS]), F.col("k") + 1)
    window = F.when(F.col("k") == 6, F.concat(F.lit('"'), F.col("event_id") * 7 % 9, F.lit('"'))).otherwise((F.col("event_id") * 7 % 9).cast("string"))
    error = F.when(F.col("k") == 4, F.lit(',"terminal_error":" timeout "')).otherwise("")
    line = F.concat(F.lit('{"window_id":'), window, F.when(F.col("event_id") % 3 > 0, F.concat(F.lit(',"repeat_index":'), F.col("event_id") % 3)).otherwise(""), error, F.lit(',"vlm_json":'), body, F.when(F.col("k") != 2, "}").otherwise(""))
    return e.select(F.floor(F.col("event_id") / 64).cast("long").alias("sample_id"), F.col("event_id").alias("line_no"), line.alias("line"))


def sql_text(s: str | None) -> str:
    return "'" + (s or "{").replace("'", "''") + "'"


LOG_SQL = f"""log AS (SELECT event_id // 64 AS sample_id, event_id AS line_no, '{{"window_id":' || CASE WHEN k = 6 THEN '"' || (event_id * 7 % 9) || '"' ELSE CAST(event_id * 7 % 9 AS VARCHAR) END
  || CASE WHEN event_id % 3 > 0 THEN ',"repeat_index":' || (event_id % 3) ELSE '' END || CASE WHEN k = 4 THEN ',"terminal_error":" timeout "' ELSE '' END || ',"vlm_json":' || [{', '.join(map(sql_text, PAYLOADS))}][k + 1] || CASE WHEN k <> 2 THEN '}}' ELSE '' END AS line
  FROM (SELECT *, CAST(event_id % 8 AS INT) AS k FROM events))"""
RESULTS_SQL = f"""{LOG_SQL}, ok AS (SELECT *, CAST(json_extract_string(line, '$.window_id') AS INT) AS window_id, coalesce(CAST(json_extract_string(line, '$.repeat_index') AS INT), 0) AS repeat_index FROM log WHERE json_valid(line)),
last AS (SELECT sample_id, window_id, repeat_index, arg_max(line, line_no) AS line FROM ok GROUP BY ALL),
x AS (SELECT *, trim(json_extract_string(line, '$.terminal_error')) AS te, CASE json_type(line, '$.vlm_json.instructions') WHEN 'VARCHAR' THEN [trim(json_extract_string(line, '$.vlm_json.instructions'))] WHEN 'ARRAY' THEN list_transform(json_extract_string(line, '$.vlm_json.instructions[*]'), lambda s: trim(s)) END AS ins,
  CASE WHEN json_type(line, '$.vlm_json.transitions') = 'ARRAY' THEN list_transform(json_extract_string(line, '$.vlm_json.transitions[*]'), lambda s: CAST(s AS INT)) ELSE [] END AS tr FROM last),
res AS (SELECT *, CASE WHEN te <> '' THEN te WHEN ins IS NULL OR len(ins) <> len(tr) + 1 OR list_contains(ins, '') OR tr <> list_sort(list_distinct(tr)) OR (len(tr) > 0 AND (list_max(tr) > 11 OR list_min(tr) <= 0)) THEN 'invalid_vlm_json' END AS error FROM x)"""


def results(spark, sf_dir):
    return L.window_results(logged(spark, sf_dir), 12)


@query("src04_compact_log", f"""WITH {RESULTS_SQL} SELECT sample_id, window_id, repeat_index, error, CASE WHEN error IS NULL THEN array_to_string(tr, ' ') END AS transitions, CASE WHEN error IS NULL THEN array_to_string(ins, '|') END AS instructions FROM res""")
def src04(spark, sf_dir):
    return results(spark, sf_dir).select("sample_id", "window_id", "repeat_index", "error", F.array_join(F.transform("result.transitions", lambda x: x.cast("string")), " ").alias("transitions"), F.array_join("result.instructions", "|").alias("instructions"))


@query("agg01_repeat_rollup", f"""WITH {RESULTS_SQL}
SELECT sample_id, window_id, count(*) FILTER (WHERE error IS NULL) AS successes, CAST(arg_min(repeat_index, -len(tr) * 100 + repeat_index) FILTER (WHERE error IS NULL) AS INT) AS chosen_repeat,
  coalesce(string_agg(repeat_index, ' ' ORDER BY repeat_index) FILTER (WHERE error IS NULL), '') AS repeats, coalesce(string_agg(repeat_index, ' ' ORDER BY repeat_index) FILTER (WHERE error IS NOT NULL), '') AS failed, arg_min(error, repeat_index) FILTER (WHERE error IS NOT NULL) AS first_error
FROM res GROUP BY ALL""")
def agg01(spark, sf_dir):
    return L.repeat_rollup(results(spark, sf_dir)).drop("result")


@query("src05_indexed_log", f"""WITH {LOG_SQL}, ok AS (SELECT sample_id, line_no, line, CAST(json_extract_string(line, '$.window_id') AS INT) AS key FROM log WHERE json_valid(line)), l AS (SELECT sample_id, key, arg_max(line, line_no) AS line FROM ok GROUP BY ALL)
SELECT sample_id, key, nullif(trim(coalesce(json_extract_string(line, '$.terminal_error'), '')), '') AS error FROM l""")
def src05(spark, sf_dir):
    rows = logged(spark, sf_dir).withColumn("v", F.try_parse_json("line")).filter("v IS NOT NULL").withColumn("key", L.whole(F.col("v"), "$.window_id")).filter("key IS NOT NULL")
    last = rows.groupBy("sample_id", "key").agg(F.max_by("line", "line_no").alias("line"))
    return last.select("sample_id", "key", F.nullif(F.trim(F.coalesce(F.try_variant_get(F.try_parse_json("line"), "$.terminal_error", "string"), F.lit(""))), F.lit("")).alias("error"))


@query("val01_checked_results", f"""WITH {RESULTS_SQL} SELECT error, count(*) AS n, CAST(coalesce(sum(len(tr)) FILTER (WHERE error IS NULL), 0) AS BIGINT) AS transitions FROM res GROUP BY ALL""")
def val01(spark, sf_dir):
    return results(spark, sf_dir).groupBy("error").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("result.transitions")).cast("long"), F.lit(0).cast("long")).alias("transitions"))


@query("pred02_completed_windows", f"WITH {RESULTS_SQL} SELECT sample_id, window_id FROM res WHERE error IS NULL GROUP BY ALL HAVING count(*) >= 2")
def pred02(spark, sf_dir):
    return L.repeat_rollup(results(spark, sf_dir)).filter("successes >= 2").select("sample_id", "window_id")


@query("join02_pending_windows", f"WITH {RESULTS_SQL} SELECT s.sample_id, w.window_id, r.repeat_index FROM (SELECT DISTINCT sample_id FROM log) s, (SELECT CAST(unnest(range(9)) AS INT) AS window_id) w, (SELECT CAST(unnest(range(3)) AS INT) AS repeat_index) r EXCEPT SELECT sample_id, window_id, repeat_index FROM res WHERE error IS NULL")
def join02(spark, sf_dir):
    log = logged(spark, sf_dir)
    planned = log.select("sample_id").distinct().withColumn("window_id", F.explode(F.sequence(F.lit(0), F.lit(8)))).withColumn("repeat_index", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return planned.join(L.window_results(log, 12).filter("error IS NULL"), ["sample_id", "window_id", "repeat_index"], "left_anti")


@query("txt24_json_in_text", f"""WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '```json' || chr(10) || '{{"k":' || event_id || '}}' || chr(10) || '```' WHEN 1 THEN 'so: {{"k":' || event_id || '}} ok' WHEN 2 THEN '{{"k":' || event_id ELSE 'none' END AS txt FROM events),
c AS (SELECT event_id, trim(replace(replace(txt, '```json', ''), '```', ''), ' ' || chr(10)) AS x FROM t)
SELECT event_id, CASE WHEN json_valid(x) THEN json_extract_string(x, '$.k') WHEN json_valid(regexp_extract(x, '\\{{.*\\}}')) THEN json_extract_string(regexp_extract(x, '\\{{.*\\}}'), '$.k') END AS k FROM c""")
def txt24(spark, sf_dir):
    e, k = table(spark, sf_dir, "events"), F.col("event_id") % 4
    body = F.concat(F.lit('{"k":'), "event_id", F.lit("}"))
    text = F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 1, F.concat(F.lit("so: "), body, F.lit(" ok"))).when(k == 2, F.concat(F.lit('{"k":'), "event_id")).otherwise("none")
    return e.select("event_id", F.try_variant_get(L.json_in(F.regexp_replace(text, "\n", " ")), "$.k", "string").alias("k"))
