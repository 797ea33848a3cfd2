"""Queries of models' answers: responses, streams, checked summaries and subtitles, diagnostics and render facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import payloads as A
from ..sources.fixtures import table
from . import merging as M
from .catalog import query

# Bodies by event_id modulo 9, @ stands for the event's id, and what they hold: an object stated as parsed, an empty one, a text of JSON, fenced JSON in an
# output's content, a text without JSON, nothing but a count of tokens, an array in a text, no JSON at all, nothing.
RESPONSES = ['{"output_parsed":{"k":@}}', '{"output_parsed":{}}', '{"output_text":"{\\"k\\":@}"}', '{"output":[{"content":[{"text":" "},{"text":"so ```json{\\"k\\":@}```"}]}]}', '{"text":"none"}', '{"usage":{"output_tokens":7}}', '{"text":"[1]"}', "{", '{"output":[]}']
CHATS = ['{"choices":[{"message":{"parsed":{"k":@}}}]}', '{"choices":[{"message":{"content":"{}"}}]}', '{"choices":[{"message":{"content":"{\\"k\\":@}"}}]}', '{"choices":[{"message":{"content":[{"text":" "},{"text":"so ```json{\\"k\\":@}```"}]}}]}', '{"choices":[{"message":{"content":"none"}}]}', '{"choices":[],"usage":{"completion_tokens":7}}', '{"choices":[{"message":{"content":"[1]"}}]}', "[]", '{"choices":[]}']
HELD_SQL = "CASE WHEN k IN (0, 2, 3) THEN '{\"k\":' || id || '}' END AS payload, CASE k WHEN 1 THEN 'structured_payload_empty' WHEN 4 THEN 'parse_failure' WHEN 5 THEN 'content_missing' WHEN 6 THEN 'body_shape_mismatch' WHEN 7 THEN 'body_shape_mismatch' WHEN 8 THEN 'body_shape_mismatch' END AS reason"


def bodies(spark, sf_dir, forms):
    of = F.element_at(F.array(*[F.lit(f) for f in forms]), (F.col("event_id") % 9 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.replace(of, F.lit("@"), F.col("event_id").cast("string")).alias("body"))


@query("txt25_responses", f"SELECT id, {HELD_SQL} FROM (SELECT event_id AS id, event_id % 9 AS k FROM events)")
def txt25(spark, sf_dir):
    return A.answers(bodies(spark, sf_dir, RESPONSES), "$.output_parsed", A.response_texts)


@query("txt25_chat_answers", f"SELECT id, {HELD_SQL} FROM (SELECT event_id AS id, event_id % 9 AS k FROM events)")
def txt25_chat(spark, sf_dir):
    return A.answers(bodies(spark, sf_dir, CHATS), "$.choices[0].message.parsed", A.chat_texts)


@query("txt26_streamed_answers", """WITH l AS (SELECT event_id // 20 AS id, event_id AS n, event_id % 20 AS k FROM events)
SELECT id, coalesce(string_agg(n || ' ', '' ORDER BY n) FILTER (WHERE k % 4 = 1 AND k < 15), '') AS text FROM l WHERE k % 4 IN (1, 2) OR k = 15 GROUP BY ALL""")
def txt26(spark, sf_dir):
    k = F.col("event_id") % 20
    piece = F.concat(F.lit('data: {"choices":[{"delta":{"content":"'), F.col("event_id").cast("string"), F.lit(' "}}]}'))
    line = F.when(k == 15, "data: [DONE]").when(k % 4 == 1, piece).when(k % 4 == 2, "data: {broken").when(k % 4 == 3, "").otherwise(": ping")
    return A.streamed(table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 20).cast("long").alias("id"), F.col("event_id").alias("line_no"), line.alias("line")))


@query("txt27_payload_facts", """SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'choices usage' WHEN 1 THEN 'a b c d e f g h i j k l' ELSE '' END AS keys, CASE event_id % 4 WHEN 0 THEN event_id % 50 END AS tokens, CASE WHEN event_id % 4 = 0 THEN 'stop length' ELSE '' END AS reasons FROM events""")
def txt27(spark, sf_dir):
    k, n = F.col("event_id") % 4, (F.col("event_id") % 50).cast("string")
    chat = F.concat(F.lit('{"usage":{"total_tokens":'), n, F.lit('},"choices":[{"finish_reason":"stop"},{"finish_reason":""},{},{"finish_reason":"length"}]}'))
    many = "{" + ",".join(f'"{c}":1' for c in "nmlkjihgfedcba") + "}"
    v = F.try_parse_json(F.when(k == 0, chat).when(k == 1, many).when(k == 2, "[1]").otherwise("nothing"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.array_join(A.top_keys(v), " ").alias("keys"), A.output_tokens(v).alias("tokens"), F.array_join(F.coalesce(A.finish_reasons(v), F.array().cast("array<string>")), " ").alias("reasons"))


# Ids begin at 0, 1 or 100 by sample; the last third is asked for by place. Some samples are asked wrongly.
ITEMS_SQL = f"""{M.RANGES_SQL}, off AS (SELECT sample_id, n, [0, 1, 100][CAST(sample_id % 3 + 1 AS INT)] AS off FROM sizes),
items AS (SELECT r.sample_id, 'coarse' AS level, start_idx AS ord, start_idx + CASE WHEN off = 1 THEN 1 ELSE 0 END AS s, CASE WHEN r.sample_id % 13 = 0 AND start_idx > 0 THEN NULL WHEN r.sample_id % 7 = 0 THEN end_idx + 1 + CASE WHEN off = 1 THEN 1 ELSE 0 END ELSE end_idx + CASE WHEN off = 1 THEN 1 ELSE 0 END END AS e,
  CASE WHEN r.sample_id % 17 = 0 AND start_idx > 0 THEN ' ' ELSE 'part' END AS summary, n, off FROM ranges r JOIN off USING (sample_id)
  UNION ALL SELECT g.sample_id, 'fine', seg_id, seg_id + CASE WHEN off = 1 THEN 1 ELSE 0 END, seg_id + CASE WHEN off = 1 THEN 1 ELSE 0 END, 'step', n, off FROM segments g JOIN off USING (sample_id) WHERE NOT (g.sample_id % 11 = 0 AND seg_id = n - 1 AND n > 1))"""


def _way(first_id: bool) -> tuple[str, str]:
    of = lambda c: f"CASE WHEN {c} - off BETWEEN 0 AND n - 1 THEN {c} - off WHEN {c} BETWEEN 0 AND n - 1 THEN {c} END" if first_id else f"CASE WHEN {c} BETWEEN 0 AND n - 1 THEN {c} WHEN {c} - off BETWEEN 0 AND n - 1 THEN {c} - off END"
    return of("s"), of("e")


def _reasons_sql(name: str, first_id: bool) -> str:
    s, e = _way(first_id)
    return f"""{name}0 AS (SELECT *, {s} AS a, {e} AS b FROM items), {name}1 AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY sample_id, level ORDER BY ord) + 1, CASE WHEN lag(ord) OVER (PARTITION BY sample_id, level ORDER BY ord) IS NULL THEN 0 ELSE 0 END) AS x FROM {name}0),
{name}2 AS (SELECT *, CASE WHEN s IS NULL OR e IS NULL THEN 'invalid_' || level || '_ranges' WHEN trim(summary) = '' THEN 'invalid_' || level || '_summary' WHEN a IS NULL OR b IS NULL OR a <> x OR b < a THEN 'invalid_' || level || '_partition' END AS bad FROM {name}1),
{name} AS (SELECT sample_id, level, n, arg_min(bad, ord) FILTER (WHERE bad IS NOT NULL) AS bad, arg_max(coalesce(b, -9), ord) AS last FROM {name}2 GROUP BY ALL)"""


REASONS_SQL = f"""{ITEMS_SQL}, {_reasons_sql("i", True)}, {_reasons_sql("p", False)},
reasons AS (SELECT i.sample_id, i.level, CASE WHEN p.bad IS NULL AND p.last = p.n - 1 THEN 'ok' WHEN i.bad IS NOT NULL THEN i.bad WHEN i.last <> i.n - 1 THEN 'incomplete_' || i.level || '_partition' ELSE 'ok' END AS reason FROM i JOIN p ON p.sample_id = i.sample_id AND p.level = i.level)"""


def items(spark, sf_dir):
    """(items of two levels, ids) of the fixture."""
    s, _, ranges = M.parts(spark, sf_dir)
    k = F.col("sample_id")
    base = F.when(k % 3 == 0, 0).when(k % 3 == 1, 1).otherwise(100).cast("long")
    ids = s.select("sample_id", F.col("seg_id").alias("idx"), (F.col("seg_id") + base).alias("seg_id"))
    asked = F.when(k % 3 == 1, 1).otherwise(0).cast("long")
    end = F.when((k % 13 == 0) & (F.col("start_idx") > 0), None).when(k % 7 == 0, F.col("end_idx") + 1 + asked).otherwise(F.col("end_idx") + asked)
    coarse = ranges.select("sample_id", F.lit("coarse").alias("level"), F.col("start_idx").alias("ord"), (F.col("start_idx") + asked).alias("start_id"), end.alias("end_id"), F.when((k % 17 == 0) & (F.col("start_idx") > 0), " ").otherwise("part").alias("summary"))
    fine = M.counted(s).filter(~((k % 11 == 0) & (F.col("seg_id") == F.col("n") - 1) & (F.col("n") > 1)))
    fine = fine.select("sample_id", F.lit("fine").alias("level"), F.col("seg_id").alias("ord"), (F.col("seg_id") + asked).alias("start_id"), (F.col("seg_id") + asked).alias("end_id"), F.lit("step").alias("summary"))
    return coarse.unionByName(fine), ids


@query("val07_level_reasons", f"WITH {REASONS_SQL} SELECT * FROM reasons")
def val07(spark, sf_dir):
    return A.level_reasons(*items(spark, sf_dir))


@query("join12_token_places", f"WITH {ITEMS_SQL} SELECT sample_id, level, ord, {_way(True)[0]} AS start_idx, {_way(True)[1]} AS end_idx FROM items")
def join12(spark, sf_dir):
    rows, ids = items(spark, sf_dir)
    return A.with_places(rows, ids, ["start_id", "end_id"]).select("sample_id", "level", "ord", F.col("start_id_by_id").alias("start_idx"), F.col("end_id_by_id").alias("end_idx"))


@query("stg02_summaries_or_identity", f"""WITH {REASONS_SQL}, told AS (SELECT sample_id, bool_and(reason = 'ok') AND sample_id % 19 <> 0 AS fine FROM reasons GROUP BY sample_id)
SELECT sample_id, level, {_way(True)[0]} AS start_idx, {_way(True)[1]} AS end_idx, true AS applied FROM items JOIN told USING (sample_id) WHERE fine
UNION ALL SELECT sample_id, l, seg_id, seg_id, false FROM (SELECT sample_id, seg_id, unnest(['coarse', 'fine']) AS l FROM segments LEFT JOIN told USING (sample_id) WHERE NOT coalesce(fine, false))""")
def stg02(spark, sf_dir):
    rows, ids = items(spark, sf_dir)
    return A.summaries_or_identity(rows, ids, ids.filter("sample_id % 19 = 0"))


@query("val09_subtitle_reasons", f"""WITH {M.RANGES_SQL} SELECT sample_id, CASE WHEN sample_id % 7 = 0 OR (sample_id % 5 = 0 AND n > 1) OR (sample_id % 11 = 0) THEN 'invalid_subtitles' ELSE 'ok' END AS reason FROM sizes""")
def val09(spark, sf_dir):
    s, k = M.parts(spark, sf_dir)[0], F.col("sample_id")
    base = F.when(k % 3 == 1, 1).otherwise(0).cast("long")
    ids = s.select("sample_id", F.col("seg_id").alias("idx"), (F.col("seg_id") + base).alias("seg_id"))
    token = F.when(k % 5 == 0, base).otherwise(F.col("seg_id") + base)  # all for the first segment
    text = F.when((k % 7 == 0) & (F.col("seg_id") == 0), " ").otherwise("said")
    return A.subtitle_reasons(s.filter(~((k % 11 == 0) & (F.col("seg_id") == 0))).select("sample_id", token.alias("token"), text.alias("subtitle")), ids)


@query("map03_fallbacks", """SELECT event_id AS id, event_id % 2 = 0 OR event_id % 3 = 0 AS applied, concat_ws(' ', CASE WHEN event_id % 3 = 0 THEN 'merge_fallback_used' END, CASE WHEN event_id % 2 = 0 THEN 'summary_fallback_used' END) AS fields,
  concat_ws(' ', CASE WHEN event_id % 2 = 0 AND event_id % 5 > 0 THEN 'empty' END, CASE WHEN event_id % 3 = 0 THEN event_type END) AS reasons FROM events""")
def map03(spark, sf_dir):
    k = F.col("event_id")
    flag = lambda n: F.when(k % n == 0, "true").otherwise("false")
    late = F.concat(F.lit("z"), F.col("event_type"))
    m = F.create_map(F.lit("summary_fallback_used"), flag(2), F.lit("summary_fallback_reason"), F.lit(" "), F.lit("summary_reason"), F.when(k % 5 > 0, "empty").otherwise(""), F.lit("merge_fallback_used"), flag(3), F.lit("merge_fallback_reason"), late, F.lit("other"), F.lit("true"))
    o = A.fallback_overview(m)
    # reasons are sorted: the z keeps the second one last and is taken off for the comparison
    shown = F.array_join(F.transform(o["reasons"], lambda r: F.when(r.startswith("z"), F.substr(r, F.lit(2))).otherwise(r)), " ")
    return table(spark, sf_dir, "events").select(k.alias("id"), o["applied"].alias("applied"), F.array_join(o["fields"], " ").alias("fields"), shown.alias("reasons"))


@query("txt21_caption_places", "SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN 'w-tw-24' WHEN 1 THEN '24' WHEN 2 THEN 'w-tw-24' WHEN 3 THEN '24' END AS x, CASE event_id % 5 WHEN 0 THEN '16' WHEN 1 THEN '16' WHEN 2 THEN 'h-th-16' WHEN 3 THEN 'h-th-16' END AS y FROM events")
def txt21(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in ("top_right", " TOP_LEFT", "bottom_right", "bottom_left", "middle")])
    at = A.caption_place(F.element_at(names, (F.col("event_id") % 5 + 1).cast("int")), 24, 16)
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), at["x"].alias("x"), at["y"].alias("y"))


@query("val13_render_facts", """SELECT event_id AS id, concat_ws(',', CASE event_id % 4 WHEN 1 THEN 'invalid_render_fact:audio' END, CASE WHEN event_id % 3 = 1 THEN 'invalid_render_fact:frames' END, CASE WHEN event_id % 3 = 2 THEN 'missing_render_fact:frames' END) AS problems FROM events""")
def val13(spark, sf_dir):
    k = F.col("event_id")
    audio = F.when(k % 4 == 1, '"yes"').when(k % 4 == 2, "true").otherwise("false")
    body = F.concat(F.lit('{"audio":'), audio, F.when(k % 3 == 0, F.concat(F.lit(',"frames":'), k.cast("string"))).when(k % 3 == 1, F.lit(',"frames":-1')).otherwise(F.lit("")), F.lit("}"))
    return table(spark, sf_dir, "events").select(k.alias("id"), F.array_join(A.render_facts(F.try_parse_json(body), ["audio"], ["frames"]), ",").alias("problems"))


@query("pred04_confirmed_abstentions", "SELECT o_orderkey AS id, o_orderkey % 3 = 1 AS confirms FROM orders")
def pred04(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    said = F.when(k == 0, F.array(F.lit(" "))).when(k == 1, F.array(F.lit("a task"), F.lit(""))).otherwise(F.array(F.lit("a"), F.lit("b")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.size(F.filter(said, lambda t: F.trim(t) != "")) == 1).alias("confirms"))


@query("join15_neighbours", f"WITH {M.SEGMENTS_SQL} SELECT * FROM (SELECT sample_id, seg_id, lead(seg_id) OVER w AS next_id, lead(instruction) OVER w AS next_text FROM segments WINDOW w AS (PARTITION BY sample_id ORDER BY seg_id)) WHERE next_id IS NOT NULL")
def join15(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("sample_id").orderBy("seg_id")
    return M.segments(spark, sf_dir).select("sample_id", "seg_id", F.lead("seg_id").over(w).alias("next_id"), F.lead("instruction").over(w).alias("next_text")).filter("next_id IS NOT NULL")


@query("join17_sample_states", "SELECT c_custkey AS id, coalesce(max(o_orderstatus), 'pending') AS state FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def join17(spark, sf_dir):
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("state"))
    return table(spark, sf_dir, "customer").join(last, "c_custkey", "left").select(F.col("c_custkey").alias("id"), F.coalesce("state", F.lit("pending")).alias("state"))


@query("set03_recovered_points", f"WITH {M.SEGMENTS_SQL} SELECT sample_id, end_excl AS point FROM segments WHERE part % 2 = 0 EXCEPT SELECT sample_id, end_excl FROM segments WHERE part % 3 = 0")
def set03(spark, sf_dir):
    s = M.segments(spark, sf_dir).select("sample_id", F.col("end_excl").alias("point"), "part")
    return s.filter("part % 2 = 0").drop("part").distinct().join(s.filter("part % 3 = 0").drop("part"), ["sample_id", "point"], "left_anti")


@query("mth01_durations", f"WITH {M.SEGMENTS_SQL} SELECT sample_id, seg_id, greatest(0, (end_excl - start_frame) / 30.0::DOUBLE) AS seconds, greatest(1, end_excl - start_frame) AS frames, greatest(2, least(5, CAST(round_even(0.2 * (10 + part % 30), 0) AS BIGINT))) AS gap FROM segments")
def mth01(spark, sf_dir):
    frames = F.col("end_excl") - F.col("start_frame")
    gap = F.greatest(F.lit(2).cast("long"), F.least(F.lit(5).cast("long"), F.rint(F.lit(0.2) * (10 + F.col("part") % 30)).cast("long")))
    return M.segments(spark, sf_dir).select("sample_id", "seg_id", F.greatest(F.lit(0.0), frames / 30.0).alias("seconds"), F.greatest(F.lit(1).cast("long"), frames).alias("frames"), gap.alias("gap"))
