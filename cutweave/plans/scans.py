"""Queries of scanned logs: labels, refinements, events, runtime records, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.windows import middle_positions
from ..sources import logs as L
from ..sources.fixtures import table
from .catalog import query

# Lines by event_id modulo their number; the first field is put before them.
LABELS = ['"vlm_json":{"instructions":" pick up "}}', '"vlm_json":{"instructions":["a"],"transitions":[]}}', '"vlm_json":{"instructions":["a","b"]}}', '"terminal_error":" timeout ","vlm_json":{}}', '"vlm_json":{"instructions":[" "]}}', '"vlm_json":', '"vlm_json":{"instructions":["a","b"],"transitions":[3]}}']
CLIPS = ['"logical_frame_count":12,"vlm_json":{"instructions":["a","b"],"transitions":[5]}}', '"frame_ids":[1,2,3,4,5,6,7,8],"logical_frame_count":40,"vlm_json":{"instructions":["a","b"],"transitions":[2]}}',
         '"meta":{"logical_frame_count":12},"vlm_json":{"instructions":["a","b"],"transitions":[9]}}', '"meta":{"frame_ids":[4,5,6,7,8,9]},"vlm_json":{"instructions":["a","b"],"transitions":[3]}}',
         '"vlm_json":{"instructions":["a","b"],"transitions":[90]}}', '"logical_frame_count":0,"terminal_error":"lost"}', '"frame_ids":[1,2],"vlm_json":{"instructions":["a"]}}', '"logical_frame_count":2,"vlm_json":{"instructions":["a","b"],"transitions":[1]}}', 'broken']
EVENTS = ['{"event":"job_done","n":1}', "[1,2]", '{"event":"x"', '"text"', '{"event":null}', "7", "", "{}"]
MANIFESTS = ['{"run_id":"r","subset":"s","data_root":"/d","run_dir":"/r","config_hash":"c","prompt_hash":"p","git_version":{"commit":"c"},"backend_summary":{},"required_stages":["a"]}',
             '{"run_id":1,"subset":"s","data_root":"/d","run_dir":"/r","config_hash":"c","prompt_hash":null,"git_version":"g","backend_summary":{},"required_stages":[]}',
             '{"run_id":"r","subset":"s"}', "[]", '{"run_id":"r","subset":"s","data_root":"/d","run_dir":"/r","config_hash":"c","prompt_hash":"p","git_version":{},"backend_summary":[],"required_stages":["a",1]}']


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def bodies(texts: list[str]) -> str:
    return f"[{', '.join(map(quoted, texts))}][CAST(event_id % {len(texts)} AS INT) + 1]"


def body(texts: list[str]):
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("event_id") % len(texts) + 1).cast("int"))


def log_of(spark, sf_dir, key: str, texts: list[str]):
    e = table(spark, sf_dir, "events")
    line = F.concat(F.lit('{"' + key + '":'), (F.col("event_id") * 7 % 11).cast("string"), F.lit(","), body(texts))
    return e.select(F.floor(F.col("event_id") / 16).cast("long").alias("sample_id"), F.col("event_id").alias("line_no"), line.alias("line"))


def last_sql(key: str, texts: list[str]) -> str:
    return f"""log AS (SELECT event_id // 16 AS sample_id, event_id AS line_no, '{{"{key}":' || (event_id * 7 % 11) || ',' || {bodies(texts)} AS line FROM events),
l AS (SELECT sample_id, CAST(json_extract_string(line, '$.{key}') AS INT) AS {key}, arg_max(line, line_no) AS line FROM log WHERE json_valid(line) GROUP BY ALL),
x AS (SELECT *, nullif(trim(coalesce(json_extract_string(line, '$.terminal_error'), '')), '') AS te,
  CASE json_type(line, '$.vlm_json.instructions') WHEN 'VARCHAR' THEN [trim(json_extract_string(line, '$.vlm_json.instructions'))] WHEN 'ARRAY' THEN list_transform(json_extract_string(line, '$.vlm_json.instructions[*]'), lambda s: trim(s)) END AS ins,
  CASE WHEN json_type(line, '$.vlm_json.transitions') = 'ARRAY' THEN list_transform(json_extract_string(line, '$.vlm_json.transitions[*]'), lambda s: CAST(s AS INT)) ELSE [] END AS tr FROM l)"""


def shown(rows, key: str):
    cuts = F.array_join(F.transform("result.transitions", lambda x: x.cast("string")), " ")
    return rows.select("sample_id", key, "error", cuts.alias("transitions"), F.array_join("result.instructions", "|").alias("instructions"))


BAD = "ins IS NULL OR len(ins) <> len(tr) + 1 OR list_contains(ins, '') OR tr <> list_sort(list_distinct(tr)) OR coalesce(list_min(tr) <= 0, false)"
SHOWN_SQL = "error, CASE WHEN error IS NULL THEN array_to_string(tr, ' ') END AS transitions, CASE WHEN error IS NULL THEN array_to_string(ins, '|') END AS instructions"


@query("src06_segment_labels", f"WITH {last_sql('segment_id', LABELS)}, r AS (SELECT *, coalesce(te, CASE WHEN {BAD} THEN 'invalid_vlm_json' END) AS error FROM x) SELECT sample_id, segment_id, {SHOWN_SQL} FROM r")
def src06(spark, sf_dir):
    return shown(L.segment_labels(log_of(spark, sf_dir, "segment_id", LABELS)), "segment_id")


FRAMES_SQL = """coalesce(nullif(json_array_length(line, '$.frame_ids'), 0), CASE WHEN CAST(json_extract_string(line, '$.logical_frame_count') AS INT) > 0 THEN CAST(json_extract_string(line, '$.logical_frame_count') AS INT) END,
  CASE WHEN CAST(json_extract_string(line, '$.meta.logical_frame_count') AS INT) > 0 THEN CAST(json_extract_string(line, '$.meta.logical_frame_count') AS INT) END, nullif(json_array_length(line, '$.meta.frame_ids'), 0))"""


@query("src07_boundary_refinements", f"""WITH {last_sql('boundary_id', CLIPS)}, n AS (SELECT *, {FRAMES_SQL} AS n FROM x),
a AS (SELECT *, CASE WHEN n > 2 THEN list_filter([greatest(1, n // 2 - 2), greatest(1, n // 2 - 1), least(n - 2, n // 2), least(n - 2, n // 2 + 1)], lambda i: i > 0 AND i < n - 1) ELSE [] END AS places FROM n),
r AS (SELECT *, coalesce(te, CASE WHEN {BAD} OR (n IS NOT NULL AND (coalesce(list_max(tr) > n - 1, false) OR NOT list_has_all(places, tr))) THEN 'invalid_vlm_json' END) AS error FROM a)
SELECT sample_id, boundary_id, {SHOWN_SQL} FROM r""")
def src07(spark, sf_dir):
    return shown(L.boundary_refinements(log_of(spark, sf_dir, "boundary_id", CLIPS), middle_positions), "boundary_id")


@query("val03_frame_counts", f"WITH t AS (SELECT event_id, '{{\"k\":1,' || {bodies(CLIPS)} AS line FROM events) SELECT event_id, CAST({FRAMES_SQL} AS INT) AS frames FROM t WHERE json_valid(line)")
def val03(spark, sf_dir):
    v = F.try_parse_json(F.concat(F.lit('{"k":1,'), body(CLIPS)))
    rows = table(spark, sf_dir, "events").select("event_id", v.alias("v")).filter("v IS NOT NULL")
    return rows.select("event_id", L.refinement_frames(F.col("v")).cast("int").alias("frames"))


@query("val02_submitted_results", """WITH j AS (SELECT event_id, event_type = 'click' AS refines, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 4 + event_id % 9 END AS n, event_id % 7 AS cut FROM events),
a AS (SELECT *, CASE WHEN n > 2 THEN list_filter([greatest(1, n // 2 - 2), greatest(1, n // 2 - 1), least(n - 2, n // 2), least(n - 2, n // 2 + 1)], lambda i: i > 0 AND i < n - 1) END AS places FROM j)
SELECT event_id, CASE WHEN cut > 0 AND (n IS NULL OR (cut <= n - 1 AND (NOT refines OR list_contains(places, cut)))) THEN cut END AS accepted FROM a""")
def val02(spark, sf_dir):
    k = F.col("event_id")
    jobs = table(spark, sf_dir, "events").select(k, (F.col("event_type") == "click").alias("refines"), F.when(k % 4 != 0, 4 + k % 9).alias("n"))
    sent = table(spark, sf_dir, "events").select(k, F.concat(F.lit('{"instructions":["a","b"],"transitions":['), (k % 7).cast("string"), F.lit("]}")).alias("body"))
    rows = sent.join(jobs, "event_id").withColumn("v", F.try_parse_json("body"))
    got = F.when(F.col("refines"), L.checked_within(F.col("v"), F.col("n"), middle_positions(F.col("n")))).otherwise(L.checked_within(F.col("v"), F.col("n")))
    return rows.select("event_id", F.get(got["transitions"], F.lit(0)).cast("long").alias("accepted"))


@query("src08_event_records", f"WITH t AS (SELECT event_id // 16 AS sample_id, event_id AS line_no, {bodies(EVENTS)} AS line FROM events) SELECT sample_id, line_no, json_extract_string(line, '$.event') AS event FROM t WHERE json_valid(line) AND json_type(line) = 'OBJECT'")
def src08(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 16).cast("long").alias("sample_id"), F.col("event_id").alias("line_no"), body(EVENTS).alias("line"))
    return L.event_records(log).select("sample_id", "line_no", F.try_variant_get("v", "$.event", "string").alias("event"))


@query("src09_runtime_objects", f"SELECT event_id AS sample_id, json_valid(b) AS readable, CASE WHEN json_valid(b) THEN json_extract_string(b, '$.event') END AS event FROM (SELECT event_id, {bodies(EVENTS)} AS b FROM events)")
def src09(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.col("event_id").alias("sample_id"), body(EVENTS).alias("body"))
    return L.runtime_objects(files).select("sample_id", F.col("v").isNotNull().alias("readable"), F.try_variant_get("v", "$.event", "string").alias("event"))


def _type_fails(field: str, kind: str) -> str:
    if kind == "ARRAY<STRING>":
        return f"coalesce(json_type(m, '$.{field}') <> 'ARRAY' OR len(list_filter(json_type(m, '$.{field}[*]'), lambda t: t <> 'VARCHAR')) > 0, true)"
    return f"coalesce(json_type(m, '$.{field}') <> '{'VARCHAR' if kind == 'STRING' else kind}', true)"


@query("src11_manifest_problems", f"SELECT event_id, concat_ws(',', {', '.join(f'CASE WHEN {_type_fails(k, L.MANIFEST[k])} THEN {quoted(k)} END' for k in sorted(L.MANIFEST))}) AS problems FROM (SELECT event_id, {bodies(MANIFESTS)} AS m FROM events)")
def src11(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.array_join(L.manifest_problems(F.try_parse_json(body(MANIFESTS))), ",").alias("problems"))
