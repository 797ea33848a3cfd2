"""Queries of the small functions, joins with labels and subtitles, and export plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canonical as J
from ..functions import scalars as C
from ..functions import text as T
from ..operators import segments as S
from ..operators.metrics import export_status  # noqa: F401  part of the exports' contract
from ..sources.fixtures import SEGMENTS_SQL, segments, table
from ..sources.scratch import spread
from .catalog import query


@query("txt19_wrapped_captions")
def txt19(spark, sf_dir):
    return segments(spark, sf_dir).select("instruction").distinct().withColumn("caption", C.wrapped(F.col("instruction")))


@query("txt23_language_codes", "SELECT doc_id, CASE WHEN k = 0 THEN lang WHEN k = 1 THEN 'zh' WHEN k = 2 THEN 'en' ELSE lower(source) END AS code FROM (SELECT *, doc_id % 4 AS k FROM documents)")
def txt23(spark, sf_dir):
    k = F.col("doc_id") % 4
    name = F.when(k == 0, F.concat(F.lit(" "), F.upper("lang"))).when(k == 1, "中文").when(k == 2, "EN-us ").otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", C.language_code(name).alias("code"))


@query("src02_video_facts", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 30.0::DOUBLE WHEN o_orderkey % 5 = 1 THEN 30.0 ELSE o_totalprice / 1000 END AS fps, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE greatest(0, o_orderkey % 50 - 3) END AS nframes FROM orders")
def src02(spark, sf_dir):
    k = F.col("o_orderkey")
    fps, n = C.clean_video(F.when(k % 5 == 0, float("nan")).when(k % 5 == 1, 1e-9).otherwise(F.col("o_totalprice") / 1000), F.when(k % 7 == 0, float("inf")).otherwise((k % 50 - 3).cast("double")))
    return table(spark, sf_dir, "orders").select(k.alias("id"), fps.alias("fps"), n.alias("nframes"))


@query("src12_payloads", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'image/jpeg' ELSE 'image/png' END AS mime, CASE WHEN page_id % 3 < 2 THEN octet_length(encode(url)) END AS bytes FROM pages")
def src12(spark, sf_dir):
    body = F.base64(F.encode("url", "UTF-8"))
    text = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("data:image/jpeg;base64,"), body)).when(F.col("page_id") % 3 == 1, body).otherwise("?!")
    mime, data = C.payload(text)
    return table(spark, sf_dir, "pages").select("page_id", mime.alias("mime"), F.octet_length(data).cast("long").alias("bytes"))


@query("src12_mime_types", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/webp' ELSE 'application/octet-stream' END AS mime FROM pages")
def src12_mime(spark, sf_dir):
    end = F.element_at(F.array(*[F.lit(x) for x in (".PNG", ".jpeg", ".webp", ".bin")]), (F.col("page_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", C.mime_type(F.concat("url", end)).alias("mime"))


@query("txt28_base_urls", "SELECT page_id, CASE WHEN regexp_matches(b, '^[a-z]+://[^/]+$') THEN b || '/v1' ELSE b END AS base FROM (SELECT page_id, regexp_replace(CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '^[a-z]+://[^/]+') || '//' ELSE url END, '/+$', '') AS b FROM pages)")
def txt28(spark, sf_dir):
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.regexp_extract("url", "^[a-z]+://[^/]+", 0), F.lit("//"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", C.base_url(url).alias("base"))


@query("txt30_config_hashes", """SELECT c_custkey AS id, sha256('{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS hash FROM customer""")
def txt30(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), C.config_hash({"segment": F.col("c_mktsegment"), "name": F.col("c_name")}).alias("hash"))


@query("job02_task_ids", "SELECT event_id, 'd::' || user_id || '_w' || event_id % 9 || '_r' || event_id % 3 AS task_id FROM events")
def job02(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", C.task_id(F.lit("d"), F.col("user_id"), "w", F.col("event_id") % 9, F.col("event_id") % 3).alias("task_id"))


@query("map01_merged_meta", "SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS worker FROM events")
def map01(spark, sf_dir):
    m = C.merged_meta(F.create_map(F.lit("kind"), F.col("event_type")), F.create_map(F.lit("kind"), F.lit("forged"), F.lit("worker"), F.col("user_id").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", m["kind"].alias("kind"), m["worker"].alias("worker"))


@query("arr01_distinct_names", "SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING x' ELSE c_mktsegment || ' BUILDING x' END AS names FROM customer")
def arr01(spark, sf_dir):
    names = F.array(F.concat(F.lit(" "), "c_mktsegment"), F.lit(""), F.lit("BUILDING "), F.col("c_mktsegment"), F.lit("x"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.array_join(C.distinct_names(names), " ").alias("names"))


@query("arr02_sequence_ids", "WITH l AS (SELECT l_orderkey AS id, list(l_partkey % 6 ORDER BY l_partkey) AS a FROM lineitem GROUP BY ALL) SELECT id, array_to_string(CASE WHEN len(list_distinct(a)) = len(a) THEN a ELSE range(len(a)) END, ' ') AS ids FROM l")
def arr02(spark, sf_dir):
    a = F.transform(F.array_sort(F.collect_list("l_partkey")), lambda x: x % 6)
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(a.alias("a")).select("id", F.array_join(C.sequence_ids(F.col("a")), " ").alias("ids"))


@query("udf03_dummy_results", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 20 > 8 THEN CAST(o_orderkey % 20 // 2 AS VARCHAR) ELSE '' END AS transitions, CASE WHEN o_orderkey % 20 > 8 THEN 2 ELSE 1 END AS n FROM orders")
def udf03(spark, sf_dir):
    r = C.dummy_result(F.col("o_orderkey") % 20)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(r["transitions"], "").alias("transitions"), F.size(r["instructions"]).alias("n"))


@query("val12_manifest_diff", "SELECT a.c_custkey AS id, concat_ws(',', CASE WHEN a.c_nationkey IS DISTINCT FROM b.c_nationkey THEN 'nation' END, CASE WHEN a.c_mktsegment IS DISTINCT FROM b.c_mktsegment THEN 'segment' END) AS differing FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1")
def val12(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("m"))
    b = c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("m").alias("o"))
    return c.join(b, "c_custkey").select(F.col("c_custkey").alias("id"), F.array_join(C.differing("m", "o", ["nation", "segment"]), ",").alias("differing"))


@query("join04_deferred_labels", f"WITH {SEGMENTS_SQL} SELECT sample_id, seg_id, CASE WHEN part % 4 = 0 THEN 'label ' || part ELSE instruction END AS instruction FROM segments")
def join04(spark, sf_dir):
    s = segments(spark, sf_dir)
    labels = s.filter("part % 4 < 3").select("sample_id", "seg_id", F.when(F.col("part") % 4 == 0, F.concat(F.lit("label "), "part")).when(F.col("part") % 4 == 1, " ").otherwise("Unknown").alias("label"))
    ok = (F.trim("label") != "") & (F.lower(F.trim("label")) != "unknown")
    return s.join(labels, ["sample_id", "seg_id"], "left").select("sample_id", "seg_id", F.coalesce(F.when(ok, F.trim("label")), "instruction").alias("instruction"))


@query("join14_subtitles", f"""WITH {SEGMENTS_SQL}, i AS (SELECT sample_id, seg_id, CASE WHEN part % 50 > 0 THEN 'sub ' || seg_id ELSE '' END AS sub, instruction FROM segments),
a AS (SELECT *, bool_and(sub <> '') OVER (PARTITION BY sample_id) AS whole FROM i) SELECT sample_id, seg_id, CASE WHEN whole THEN sub ELSE instruction END AS subtitle FROM a""")
def join14(spark, sf_dir):
    from pyspark.sql import Window

    s = segments(spark, sf_dir)
    items = s.filter("part % 50 > 0").select("sample_id", "seg_id", F.concat(F.lit("sub "), "seg_id").alias("sub"))
    met = s.join(items, ["sample_id", "seg_id"], "left").withColumn("whole", F.every(F.col("sub").isNotNull()).over(Window.partitionBy("sample_id")))
    return met.select("sample_id", "seg_id", F.when(F.col("whole"), F.col("sub")).otherwise(F.coalesce(F.nullif(F.trim("instruction"), F.lit("")), F.lit(S.UNKNOWN))).alias("subtitle"))


@query("exp01_clip_manifest", f"""WITH {SEGMENTS_SQL} SELECT sample_id, seg_id, 'seg_' || lpad(CAST(seg_id AS VARCHAR), CAST(greatest(2, len(CAST(seg_id AS VARCHAR))) AS INT), '0') || '_' || coalesce(nullif(left(trim(regexp_replace(lower(instruction), '[^a-z0-9]+', '_', 'g'), '_'), 48), ''), 'segment') || '.mp4' AS name,
  round(start_frame / 30.0::DOUBLE, 6) AS start_sec, round((end_excl - start_frame) / 30.0::DOUBLE, 6) AS seconds FROM segments WHERE end_excl > start_frame""")
def exp01(spark, sf_dir):
    n = F.col("seg_id").cast("string")
    name = F.concat(F.lit("seg_"), F.lpad(n, F.greatest(F.lit(2), F.length(n)), F.lit("0")), F.lit("_"), T.slug(F.col("instruction")), F.lit(".mp4"))
    s = segments(spark, sf_dir).filter("end_excl > start_frame")
    return s.select("sample_id", "seg_id", name.alias("name"), F.round(F.col("start_frame") / 30.0, 6).alias("start_sec"), F.round((F.col("end_excl") - F.col("start_frame")) / 30.0, 6).alias("seconds"))


@query("exp02_caption_filters", f"""WITH {SEGMENTS_SQL}, f AS (SELECT sample_id, seg_id, 'drawtext=text=''' || replace(instruction, ',', '\\,') || ''':enable=''gte(t,' || start_frame // 30 || ')*lt(t,' || end_excl // 30 || ')''' AS f FROM segments WHERE end_excl - start_frame >= 45)
SELECT sample_id, string_agg(f, ',' ORDER BY seg_id) AS filters FROM f GROUP BY ALL""")
def exp02(spark, sf_dir):
    s = segments(spark, sf_dir).filter("end_excl - start_frame >= 45 AND trim(instruction) <> ''")
    whole = lambda c: F.floor(F.col(c) / 30).cast("string")
    one = F.concat(F.lit("drawtext=text='"), T.escaped(F.col("instruction")), F.lit("':enable='gte(t,"), whole("start_frame"), F.lit(")*lt(t,"), whole("end_excl"), F.lit(")'"))
    return s.groupBy("sample_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_id", one.alias("f")))), lambda x: x["f"]), ",").alias("filters"))


@query("pred03_stages_satisfied", "SELECT o_orderkey AS id, o_orderkey % 4 >= CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 3 END AS satisfied FROM orders")
def pred03(spark, sf_dir):
    k, names = F.col("o_orderkey"), F.array(F.lit("windows"), F.lit("merge"), F.lit("export"))
    done, need = F.slice(names, 1, (k % 4).cast("int")), F.slice(names, 1, F.when(k % 3 == 0, 2).otherwise(3))
    return table(spark, sf_dir, "orders").select(k.alias("id"), (F.size(F.array_except(need, done)) == 0).alias("satisfied"))


@query("txt17_seed_text", f"WITH {SEGMENTS_SQL} SELECT sample_id, arg_min(trim(instruction), [-len(trim(instruction)), seg_id]) AS instruction FROM segments GROUP BY ALL")
def txt17(spark, sf_dir):
    s = segments(spark, sf_dir)
    whole = s.groupBy("sample_id").agg(F.lit(0).cast("long").alias("start_idx"), F.max("seg_id").alias("end_idx"))
    return S.merged_by_ranges(s, whole).select("sample_id", "instruction")


@query("src01_listing", "SELECT source AS subset, doc_id % 50 AS sample, count(*) AS files FROM documents GROUP BY ALL")
def src01(spark, sf_dir):
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), (F.col("doc_id") % 50).cast("string"), F.lit("/f.mp4"))
    p = table(spark, sf_dir, "documents").select(path.alias("path"))
    return p.groupBy(F.regexp_extract("path", "^/data/([^/]+)/", 1).alias("subset"), F.regexp_extract("path", "^/data/[^/]+/([^/]+)/", 1).cast("long").alias("sample")).agg(F.count("*").alias("files"))


#: A configuration with keys in no order, secrets at several depths, and settings of backends that are not chosen.
BACKENDS = ["openai", "gemini", "remote_api", "qwen3vl", "dummy"]


@query("man02_identity_hashes", f"""WITH c AS (SELECT c_custkey AS id, {BACKENDS}[CAST(c_custkey % 5 + 1 AS INT)] AS backend, c_custkey % 2 = 0 AS merged, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment FROM customer),
b AS (SELECT *, CASE backend WHEN 'openai' THEN '{{"base_url":"u' || nation || '","headers":[{{"api_key":"stays","b":1}}],"model":"é' || segment || '"}}' WHEN 'gemini' THEN '{{"api_mode":"m","organization":"stays' || nation || '"}}'
  WHEN 'remote_api' THEN '{{"api_url":"http://' || nation || '","timeout_sec":30}}' WHEN 'qwen3vl' THEN '{{"api_key":"no secret here","model_path":"/m/' || nation || '"}}' ELSE '{{}}' END AS own FROM c)
SELECT id, sha256('{{"datasets":[{{"root":"/d/' || nation || '","subset":"' || segment || '"}}],"deployment_mode":"single_machine_shared_fs","export":{{}},"llm_merge":{{"enabled":' || CASE WHEN merged THEN 'true' ELSE 'false' END || ',"inner":{{"project":"stays"}}}},"required_stages":["stage1_segments"' || CASE WHEN merged THEN ',"stage2_text"' ELSE '' END
  || '],"windowing":{{"deep":{{"a":[1,{{"x":null,"y":2}}],"b":"' || nation || '"}},"step_sec":6}},"worker":{{"backend":"' || backend || '","selected_backend_config":' || own || '}}}}') AS hash FROM b""")
def man02(spark, sf_dir):
    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    backend = F.element_at(F.array(*[F.lit(b) for b in BACKENDS]), (k % 5 + 1).cast("int"))
    merged = k % 2 == 0
    text = F.format_string(
        '{"worker":{"qwen3vl":{"model_path":"/m/%s","api_key":"no secret here"},"openai":{"project":"p","model":"é%s","api_key":"k%s","headers":[{"b":1,"api_key":"stays"}],"organization":null,"base_url":"u%s"},"backend":"%s",'
        '"gemini":{"organization":"stays%s","api_mode":"m","api_key":1},"remote_api":{"timeout_sec":30,"api_key":"k","api_url":"http://%s"}},"llm_merge":{"project":"p%s","inner":{"project":"stays"},"enabled":%s,"api_key":"x"},'
        '"windowing":{"step_sec":6,"deep":{"b":"%s","a":[1,{"y":2,"x":null}]}},"unused":%s,"datasets":[{"subset":"%s","root":"/d/%s","more":1}]}',
        nation, F.col("c_mktsegment"), k.cast("string"), nation, backend, nation, nation, k.cast("string"), F.when(merged, "true").otherwise("false"), nation, k.cast("string"), F.col("c_mktsegment"), nation,
    )
    stages = F.array_compact(F.array(F.lit("stage1_segments"), F.when(merged, F.lit("stage2_text"))))
    # a row takes long and a file holds many rows, so these are dealt to all tasks; each text is parsed once
    parsed = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey").select(k.alias("id"), F.parse_json(text).alias("config"), stages.alias("stages"))
    return parsed.select("id", J.payload_hash(J.identity_payload(F.col("config"), F.col("stages"))).alias("hash"))


@query("txt30_reuse_groups", """WITH e AS (SELECT event_id, event_type, user_id, CASE WHEN event_id % 6 <> 0 THEN event_id % 40 END AS w, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'refined' ELSE 'coarse' END AS p FROM events)
SELECT event_id, CASE WHEN w IS NULL THEN '' ELSE 'reuse::' || left(sha256('["' || event_type || '\\u00e9\\ud83d\\ude00","' || user_id || '","window_boundary","' || CASE WHEN p = '' THEN 'coarse' ELSE p END || '",' || w || ',[' || w || ',' || (w + 7) || '],"sheet",640,480,3,4,2]'), 16) END AS reuse_group FROM e""")
def txt30b(spark, sf_dir):
    k = F.col("event_id")
    w = F.when(k % 6 != 0, k % 40)
    e = table(spark, sf_dir, "events")
    name = F.when(k % 3 == 0, "").when(k % 3 == 1, "refined").otherwise("coarse")
    key = J.reuse_key(F.concat("event_type", F.lit("é😀")), F.col("user_id"), F.lit("window_boundary"), name, w, F.array(w, w + 7), F.lit("sheet"), True, [640, 480, 3, 4, 2])
    return e.select("event_id", J.reuse_group(key).alias("reuse_group"))
