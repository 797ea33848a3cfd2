"""Answers, checks of summaries and subtitles, and splits on drift, on small and odd tables."""

import json

from pyspark.sql import functions as F

from cutweave.operators import drift, payloads


def test_answers_of_odd_bodies(spark):
    bodies = [("a", None), ("b", ""), ("c", "[]"), ("d", '{"output_text":5}'), ("e", '{"output_text":"{ {"}'), ("f", '{"text":"{\\"k\\":1}","output_parsed":{}}'), ("g", '{"output":[1,{"content":[{"text":"{\\"k\\":2}"}]}]}')]
    got = {r.id: (r.payload, r.reason) for r in payloads.answers(spark.createDataFrame(bodies, "id string, body string"), "$.output_parsed", payloads.response_texts).collect()}
    assert [got[i][1] for i in "abcdef"] == [payloads.MISMATCH] * 4 + [payloads.UNPARSED, payloads.EMPTY] and json.loads(got["g"][0]) == {"k": 2} and got["g"][1] is None


def test_streams_end_where_they_say(spark):
    piece = lambda t: "data: " + json.dumps({"choices": [{"delta": {"content": t}}]})
    rows = [(1, 3, piece("c")), (1, 1, piece("a")), (1, 2, "data: {"), (1, 4, "data: [DONE]"), (1, 5, piece("no")), (2, 1, "data: {}"), (3, 1, ": ping")]
    assert {r.id: r.text for r in payloads.streamed(spark.createDataFrame(rows, "id int, line_no int, line string")).collect()} == {1: "ac", 2: ""}


def test_summary_and_subtitle_reasons(spark):
    ids = spark.createDataFrame([(s, i, i + off) for s, off in ((1, 0), (2, 10), (3, 10)) for i in range(4)] + [(4, 0, 7), (4, 1, 7)], "sample_id int, idx long, seg_id long")
    items = spark.createDataFrame([
        (1, "coarse", 0, 0, 1, "x"), (1, "coarse", 1, 2, 3, "y"), (1, "fine", 0, 0, 2, "x"), (1, "fine", 1, 3, 3, " "),
        (2, "coarse", 0, 10, 13, "x"), (2, "fine", 0, 0, 3, "x"), (3, "coarse", 0, 10, 12, "x"), (3, "fine", 0, 10, None, "x"), (4, "coarse", 0, 0, 1, "x"),
    ], "sample_id int, level string, ord int, start_id long, end_id long, summary string")
    got = {(r.sample_id, r.level): r.reason for r in payloads.level_reasons(items, ids).collect()}
    assert got == {(1, "coarse"): "ok", (1, "fine"): "invalid_fine_summary", (2, "coarse"): "ok", (2, "fine"): "ok", (3, "coarse"): "incomplete_coarse_partition", (3, "fine"): "invalid_fine_ranges", (4, "coarse"): "ok"}
    chosen = payloads.summaries_or_identity(items, ids, ids.limit(0)).collect()
    assert {r.sample_id for r in chosen if r.applied} == {2, 4} and sum(r.sample_id == 1 for r in chosen) == 8
    later = spark.createDataFrame([(5, i, i + 1) for i in range(3)], "sample_id int, idx long, seg_id long")
    by_place = spark.createDataFrame([(5, "fine", i, i, i, "x") for i in range(3)], items.schema)
    assert sorted((r.start_idx, r.end_idx, r.applied) for r in payloads.summaries_or_identity(by_place, later, later.limit(0)).collect()) == [(i, i, True) for i in range(3)]
    said = spark.createDataFrame([(1, i, "t") for i in range(4)] + [(2, 10 + i, "t") for i in range(4)] + [(3, 10, "t")] * 4, "sample_id int, token long, subtitle string")
    assert {r.sample_id: r.reason for r in payloads.subtitle_reasons(said, ids).collect()} == {1: "ok", 2: "ok", 3: "invalid_subtitles", 4: "invalid_subtitles"}
    assert payloads.level_reasons(items.limit(0), ids).count() == 0


def test_long_segments_are_split_where_the_task_drifts(spark):
    ginger, tomato = "Add ginger paste to the pot", "Add tomatoes to the pot"
    one = spark.createDataFrame([(1, 0, 0, 900, ginger, 1.0, 0.4, 0.6), (2, 0, 0, 300, ginger, 1.0, None, None)], "sample_id int, seg_id long, start_frame long, end_excl long, instruction string, confidence double, support_before double, support_after double")
    frames = [(s, f, 0, ginger if f < n // 2 else tomato) for s, n in ((1, 900), (2, 300)) for f in range(0, n, 5)]
    timeline = spark.createDataFrame(frames, "sample_id int, frame long, ord int, instruction string")
    got = sorted((r.sample_id, r.seg_id, r.start_frame, r.end_excl, r.instruction, r.support_before, r.support_after) for r in drift.split_on_drift(one, timeline, fps=25.0).collect())
    assert got[:2] == [(1, 0, 0, 450, ginger, 0.4, 0.0), (1, 1, 450, 900, tomato, 0.0, 0.6)] and got[2][:4] == (2, 0, 0, 300) and len(got) == 3
    assert drift.split_on_drift(one.limit(0), timeline).count() == 0 and drift.split_on_drift(one, timeline.limit(0)).count() == 2


def test_fallbacks_and_facts(spark):
    row = spark.range(1).select(
        payloads.fallback_overview(F.create_map(F.lit("a_fallback_used"), F.lit("true"), F.lit("a_reason"), F.lit("late"), F.lit("b_fallback_used"), F.lit("false"))).alias("f"),
        payloads.render_facts(F.try_parse_json(F.lit('{"audio":null,"frames":2}')), ["audio", "video"], ["frames"]).alias("p"),
        payloads.caption_place(F.lit("centre"), 1, 1).alias("c"),
    ).first()
    assert row.f.applied and row.f.fields == ["a_fallback_used"] and row.f.reasons == ["late"] and row.p == ["invalid_render_fact:audio", "missing_render_fact:video"] and row.c is None
