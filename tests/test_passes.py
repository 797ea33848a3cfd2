"""The merge pass from segments to segments, requests over recorded answers, and the envelope of all passes."""

import json

from pyspark.sql import functions as F

from cutweave.operators import passes

SEG = "sample_id long, seg_id long, start_frame long, end_excl long, instruction string, confidence double, support_before double, support_after double"
TEXTS = ["Place the flat item", "Place the flat item into the target region", "Remove the hand from the target region", "Pick up the next item"]
SUPPORT = [0.0, 0.2, 0.4, 0.7, 0.8]


def asked(spark, ranges, samples=(1,)):
    attempts = spark.createDataFrame([(s, 0, None) for s in samples], "sample_id long, attempt int, problem string")
    rows = [(s, 0, i, a, b) for s in samples for i, (a, b) in enumerate(ranges)]
    return attempts, spark.createDataFrame(rows, "sample_id long, attempt int, ord int, start_id long, end_id long")


def test_a_merge_from_end_to_end(spark):
    """Three ranges over four segments: the first two join under the more specific text. Two segments are too few for another sample."""
    rows = [(s, i, 12 * i, 12 * i + 12, t, 0.8, SUPPORT[i], SUPPORT[i + 1]) for s, n in ((1, 4), (2, 2)) for i, t in enumerate(TEXTS[:n])]
    segs = spark.createDataFrame(rows, SEG)
    merged, report = passes.merged_segments(segs, *asked(spark, [(0, 1), (2, 2), (3, 3)]), coarse=False, least=4)
    got = [tuple(r) for r in merged.orderBy("sample_id", "seg_id").select("sample_id", "seg_id", "start_frame", "end_excl", "instruction").collect()]
    assert got == [(1, 0, 0, 24, TEXTS[1]), (1, 1, 24, 36, TEXTS[2]), (1, 2, 36, 48, TEXTS[3]), (2, 0, 0, 12, TEXTS[0]), (2, 1, 12, 24, TEXTS[1])]
    assert {r.sample_id: (r.reason, r.outputs) for r in report.collect()} == {1: ("applied", 3), 2: ("below_min_input_segments", 2)}


def test_supported_boundaries_and_repeated_tails_stay(spark):
    """A strong boundary inside of a range stays where each range is guarded; a last text that repeats is split off before a turn. Coarse
    ranges take one anchor and no tails."""
    texts = ["Stir the pot", "Stir the pot", "Stir the pot", "Chop the onion", "Chop the onion", "First pour the sauce", "Then pour the sauce"]
    rows = [(1, i, 30 * i, 30 * i + 30, t, 0.5, 0.1, 0.95 if i == 0 else 0.1) for i, t in enumerate(texts)]
    segs = spark.createDataFrame(rows, SEG)
    ranges = spark.createDataFrame([(1, 0, 0, 2), (1, 0, 3, 6)], "sample_id long, attempt int, start_idx long, end_idx long")
    ends = lambda **k: sorted(r.boundary for r in passes.guarded(segs, ranges, **k).collect())
    every = ends(coarse=False, support=0.9)
    assert 0 in every and 1 in every and 5 in every
    assert 1 not in ends(coarse=False, support=0.9, tail_frames=31)
    coarse = ends(coarse=True, support=0.9, limit=1, spacing=1, side=1, score=0.4)
    assert 0 in coarse and 1 not in coarse and len(coarse) == 2 and ends(coarse=True, support=0.9, score=9.0) == []


ANSWER = "sample_id long, repeat int, attempt int, payload string, exception string, message string, adapter string"


def test_requests_end_with_the_first_payload(spark):
    adapter = json.dumps({"final_failure_reason": "http_500", "chat_completions": {"error": " down "}})
    rows = [
        (1, 0, 1, None, "OSError", " lost ", None), (1, 0, 2, "{}", None, None, None), (1, 0, 3, '{"a":[]}', None, None, None), (1, 0, 4, '{"b":1}', None, None, None),
        (2, 0, 1, "[1]", None, None, None), (2, 0, 2, None, "OSError", "", None), (3, 0, 1, "{}", None, None, adapter), (4, 0, 1, '{"x":1}', "OSError", "m", adapter),
        (5, 0, 4, '{"x":1}', None, None, None), (5, 0, 1, None, None, None, "no json"), (5, 1, 1, '{"x":1}', None, None, adapter),
    ]
    got = {(r.sample_id, r.repeat): (r.payload, r.reason, r.error, r.attempts) for r in passes.requested(spark.createDataFrame(rows, ANSWER)).collect()}
    assert got == {
        (1, 0): ('{"a":[]}', "ok", "", 3), (2, 0): (None, "request_failed:OSError", "OSError", 2), (3, 0): (None, "http_500", "down", 1), (4, 0): (None, "http_500", "down", 1),
        (5, 0): (None, "empty_response", "", 1), (5, 1): ('{"x":1}', "ok", "", 1),
    }
    assert {r.attempts for r in passes.requested(spark.createDataFrame(rows[:4], ANSWER), 0).collect()} == {1}


def test_summary_and_subtitles_of_a_merge_that_failed(spark):
    segs = spark.createDataFrame([(s, i, 10 * i, 10 * i + 10, t, 1.0, 0.0, 0.0) for s in (1, 2) for i, t in enumerate(["Stir", " "])], SEG)
    report = spark.createDataFrame([(1, "request_failed:OSError"), (2, "applied")], "sample_id long, reason string")
    items = spark.createDataFrame([(1, "coarse", 0, 0, 1, "cook"), (1, "fine", 0, 0, 0, "a"), (1, "fine", 1, 1, 1, "b"), (2, "coarse", 0, 0, 0, "half")], "sample_id long, level string, ord int, start_id long, end_id long, summary string")
    asked_for = spark.createDataFrame([(1, "zh", None), (2, "en", None)], "sample_id long, language string, problem string")
    said = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "sample_id long, token long, subtitle string")
    out, trees, lines = passes.stage_envelope(segs, report, items, ["coarse", "fine"], asked_for, said)
    assert {r.sample_id: tuple(r)[1:] for r in out.collect()} == {
        1: (False, "request_failed:OSError", 2, True, 1, True, "applied", "zh"), 2: (True, "applied", 2, False, 2, False, "source_instruction_reused", "en"),
    }
    roots = {r.sample_id: json.loads(r.j) for r in trees.select("sample_id", F.to_json("roots").alias("j")).collect()}
    assert [(x["summary"], [c["summary"] for c in x["children"]]) for x in roots[1]] == [("cook", ["a", "b"])] and [x["summary"] for x in roots[2]] == ["Stir", "Unknown task step"]
    assert {(r.sample_id, r.seg_id): r.subtitle for r in lines.collect()} == {(1, 0): "x", (1, 1): "y", (2, 0): "Stir", (2, 1): "Unknown task step"}
