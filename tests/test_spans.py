"""Spans: joins of spans, matches in one pass, refined boundaries and nested levels."""

import json
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cutweave.operators import assembly, evaluate, hierarchy, intervals, segments

SPAN = "sample_id long, a long, s long, e long"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps_are_those_of_all_pairs(spark, seed):
    """Spans of one to a million frames, before zero as well, empty ones and NULL bounds."""
    rng = random.Random(seed)
    make = lambda n: [(rng.randrange(3), i, s, s + rng.choice([0, 1, 3, 8, 9, 64, 500, 513, 4096, 10**6])) for i in range(n) for s in [rng.randrange(-3000, 6000)]]
    left, right = make(120), make(90)
    odd = [(0, 998, None, 5), (0, 999, 5, None)]
    a = spark.createDataFrame(left + odd, SPAN)
    b = spark.createDataFrame(right + odd, SPAN).select("sample_id", F.col("a").alias("b"), F.col("s").alias("t"), F.col("e").alias("f"))
    for inclusive in (False, True):
        met = intervals.overlapping(a, b, ["sample_id"], ("s", "e", "t", "f"), inclusive)
        got = [(r.a, r.b) for r in met.collect()]
        want = [(x[1], y[1]) for x in left for y in right if x[0] == y[0] and x[2] < y[3] + inclusive and y[2] < x[3]]
        assert sorted(got) == sorted(want) and met.columns == ["sample_id", "a", "s", "e", "b", "t", "f"]
    assert intervals.overlapping(a.limit(0), b, ["sample_id"], ("s", "e", "t", "f")).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_every_left_row_comes_with_its_overlaps(spark, seed):
    """Spans that follow each other, with gaps and equal starts, and a few that overlap those before; left rows without a key or bounds stay."""
    rng = random.Random(seed)

    def follow(n):
        rows, at = [], 0
        for i in range(n):
            s, at = at, at + rng.choice([1, 2, 5, 9, 70])
            rows.append((i % 2, i, s, at))
            at += rng.choice([0, 0, 3, 40])
        return [*rows, *[(k, n + i, s, s + rng.choice([0, 6, 300])) for i, (k, _, s, _) in enumerate(rng.sample(rows, 8))]]

    left, right = follow(80), follow(70)
    odd = [(0, 998, None, 5), (None, 999, 5, 90), (9, 997, 5, 90)]
    a = spark.createDataFrame(left + odd, SPAN)
    b = spark.createDataFrame(right + odd[:2], SPAN).select("sample_id", F.col("a").alias("b"), F.col("s").alias("t"), F.col("e").alias("f"))
    got = [(r.a, r.b) for r in intervals.overlapping(a, b, ["sample_id"], ("s", "e", "t", "f"), every=True).collect()]
    want = [(x[1], y[1]) for x in left for y in right if x[0] == y[0] and x[2] < y[3] and y[2] < x[3]]
    assert sorted(x for x in got if x[1] is not None) == sorted(want) and {x[0] for x in got} == {x[1] for x in left + odd}


def test_a_sample_of_a_million_frames(spark):
    """One sample, 20,000 segments, a label for each frame: each frame meets its segment in a cell, not each segment of the sample."""
    n, each = 1_000_000, 50
    frames = spark.range(n).select(F.lit(7).cast("long").alias("sample_id"), F.col("id").alias("frame"), F.lit(0).alias("ord"), F.when(F.col("id") % each < 30, "stir").otherwise("pour").alias("instruction"))
    cut = spark.range(n // each).select(F.lit(7).cast("long").alias("sample_id"), F.col("id").alias("seg_id"), (F.col("id") * each).alias("start_frame"), ((F.col("id") + 1) * each).alias("end_excl"))
    began = time.time()
    found = segments.majority_texts(cut, frames)
    assert found.groupBy("instruction").count().collect() == [("stir", n // each)]
    assert time.time() - began < 90
    joins = [x for x in plan(found).splitlines() if "Join" in x]
    assert any("__cell" in x for x in joins) and not any("frame" in x and "__cell" not in x for x in joins)


def slow_matches(truth, predicted, tolerance):
    """Each true boundary, ascending, takes the first prediction that is not too early and not taken."""
    truth, predicted, at, used, out = sorted(truth), sorted(predicted), 0, set(), []
    for frame, idx in truth:
        while at < len(predicted) and predicted[at] < frame - tolerance:
            at += 1
        hit = at < len(predicted) and predicted[at] <= frame + tolerance
        out.append((frame, idx, predicted[at] if hit else None))
        if hit:
            used.add(at)
            at += 1
    left = [p for i, p in enumerate(predicted) if i not in used]
    return {(f, i, m is not None, m if m is not None else min(((abs(p - f), p) for p in left), default=(0, None))[1]) for f, i, m in out}


@pytest.mark.parametrize("seed", range(4))
def test_matches_of_dense_boundaries(spark, seed):
    rng = random.Random(seed)
    spread = [20, 60, 300, 2000][seed]
    truth = {s: [(rng.randrange(spread), i) for i in range(40)] for s in range(4)}
    predicted = {s: [rng.randrange(spread) for _ in range(rng.choice([0, 10, 60]))] for s in range(5)}
    t = spark.createDataFrame([(s, i, f) for s, x in truth.items() for f, i in x] + [(9, 0, None)], "sample_id long, idx long, frame long")
    p = spark.createDataFrame([(s, f) for s, x in predicted.items() for f in x] + [(0, None)], "sample_id long, frame long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")  # a sample lies in several batches
    try:
        got = evaluate.matches(t, p, 5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for s in truth:
        assert {(r.frame, r.idx, r.hit, r.pred_frame) for r in got if r.sample_id == s} == slow_matches(truth[s], predicted[s], 5)
    assert {r.sample_id for r in got} == set(truth) and evaluate.matches(t.limit(0), p).count() == 0


def test_matches_take_linear_time(spark):
    n = 300_000
    t = spark.range(n).select(F.lit(1).cast("long").alias("sample_id"), F.col("id").alias("idx"), (F.col("id") * 4).alias("frame"))
    p = spark.range(n).select(F.lit(1).cast("long").alias("sample_id"), (F.col("id") * 4 + F.col("id") % 3).alias("frame"))
    began = time.time()
    assert evaluate.matches(t, p, 2).filter("hit").count() == n and time.time() - began < 90


SEG = "sample_id long, seg_id long, start_frame long, end_excl long, instruction string, confidence double, support_before double, support_after double"
TOLD = "sample_id long, seg_id long, frame_ids array<long>, transitions array<int>, instructions array<string>"
IDS = [60, 70, 80, 90, 95, 100, 105, 110, 120, 130, 140, 150]


def refined(spark, segs, told, fps=25.0, most=-1.0):
    rows = [(1, i, s, e, t, c, b, a) for i, (s, e, t, c, b, a) in enumerate(segs)]
    out = assembly.refined_boundaries(spark.createDataFrame(rows, SEG), spark.createDataFrame([(1, *x) for x in told], TOLD), fps, most)
    return [tuple(r)[2:] for r in out.orderBy("seg_id").collect()]


def test_a_refinement_moves_a_boundary(spark):
    segs = [(0, 100, "Add spices to the pot", 1.0, None, None), (100, 220, "Stir the ingredients in the pot", 1.0, None, None)]
    assert refined(spark, segs, [(0, IDS, [4], ["Add spices", "Stir the pot"])]) == [(0, 95, *segs[0][2:]), (95, 220, *segs[1][2:])]
    assert refined(spark, segs, [(0, IDS, [-1, 99, 4], None)])[0][1] == 95 and refined(spark, segs, [(0, IDS, [], ["a", "b"])]) == segs
    assert refined(spark, segs, [(0, [500], [0], ["a"])])[0][1] == 219 and refined(spark, segs, [(0, [0], [0], ["a"])])[0][1] == 1


def test_an_abstention_takes_a_weak_boundary_away(spark):
    weak = [(0, 100, "Prepare ingredients on the counter", 1.0, None, 0.0), (100, 220, "Chop the tomatoes on the cutting board", 1.0, 0.0, None)]
    assert refined(spark, weak, [(0, IDS, [], ["same task"])], most=0.0) == [(0, 220, "Chop the tomatoes on the cutting board", 1.0, None, 0.0)]
    assert len(refined(spark, weak, [(0, IDS, [], ["same task"])])) == 2 and len(refined(spark, weak, [(0, IDS, [], [])], most=0.0)) == 2
    strong = [(0, 100, "Add spices to the pot", 1.0, None, 1.4), (100, 220, "Stir the ingredients in the pot", 1.0, 1.4, None)]
    assert refined(spark, strong, [(0, IDS, [], ["same task"])], most=0.0) == strong


def test_boundaries_after_one_that_goes(spark):
    """Boundary 1 goes; boundary 2 lies after boundary 0's new place; known supports are written to both sides, the joined one keeps its own."""
    segs = [(0, 100, "Add salt", 0.5, 0.1, 0.7), (100, 200, "Stir the pot", 0.6, 0.2, 0.3), (200, 300, "Stir the pot", 0.7, 0.1, None), (300, 400, "Pour the sauce", 0.8, None, 0.9)]
    got = refined(spark, segs, [(0, [180], [0], ["a"]), (1, IDS, [], [" one ", ""]), (2, [150], [0], ["b"])], most=0.3)
    assert got == [(0, 180, "Add salt", 0.5, 0.1, 0.7), (180, 201, "Stir the pot", 0.6, 0.7, 0.3), (201, 400, "Pour the sauce", 0.8, None, 0.9)]
    assert assembly.refined_boundaries(spark.createDataFrame([], SEG), spark.createDataFrame([], TOLD)).count() == 0


RANGE = "sample_id long, level string, start_idx long, end_idx long, summary string"


def test_three_levels_of_four_segments(spark):
    segs = spark.createDataFrame([(1, i, i * 10, i * 10 + 10) for i in range(4)], "sample_id long, seg_id long, start_frame long, end_excl long")
    ranges = [("coarse", 0, 1, "first"), ("coarse", 2, 3, " second "), ("medium", 0, 1, "load one"), ("medium", 2, 3, None), *[("fine", i, i, f"step {i}") for i in range(4)]]
    made = spark.createDataFrame([(1, *r) for r in ranges], RANGE)
    (row,) = hierarchy.nested(made, segs, ["coarse", "medium", "fine"]).select(F.to_json("roots").alias("j")).collect()
    roots = json.loads(row.j)
    assert [(r["summary"], r["start_frame"], r["end_frame"]) for r in roots] == [("first", 0, 20), ("second", 20, 40)]
    assert [c["summary"] for r in roots for c in r["children"]] == ["load one", ""] and [g["summary"] for r in roots for c in r["children"] for g in c["children"]] == ["step 0", "step 1", "step 2", "step 3"]
    flat = hierarchy.nested(made, segs, ["fine"]).first().roots
    assert [x.summary for x in flat] == ["step 0", "step 1", "step 2", "step 3"]
    assert hierarchy.nested(made.limit(0), segs, ["coarse", "fine"]).count() == 0
    crossing = spark.createDataFrame([(1, "coarse", 0, 1, "a"), (1, "coarse", 2, 3, "b"), (1, "fine", 0, 0, "x"), (1, "fine", 1, 2, "lost"), (1, "fine", 3, 3, "y")], RANGE)
    assert [[c.summary for c in r.children] for r in hierarchy.nested(crossing, segs, ["coarse", "fine"]).first().roots] == [["x"], ["y"]]


def test_window_frames_compile(spark):
    """No generated method of the dearest generator is above the 8,000 bytes that the JVM compiles."""
    import re

    import __spark_entry__ as entry

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = entry.queries()["win02_even_frames"](spark, "/root/testdata/sf0.001")
        told = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told)) < 8000


def test_matches_deal_a_union_of_dealt_sides(spark):
    w = Window.partitionBy("sample_id").orderBy("frame")
    made = lambda: spark.range(400).select((F.col("id") % 5).alias("sample_id"), (F.floor(F.col("id") / 5) * 20).alias("frame")).withColumn("idx", F.row_number().over(w).cast("long"))
    truth = made().filter("idx > 0").select("sample_id", (F.col("frame") - 5).alias("turn"), "frame", "idx", F.lit(True).alias("true"))
    predicted = made().filter("idx % 7 > 0").select("sample_id", F.col("frame").alias("turn"), "frame", F.lit(None).cast("long").alias("idx"), F.lit(False).alias("true"))
    found = evaluate.greedy_matches(truth.unionByName(predicted), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan[: plan.index("Union")]
    assert found.filter("mate = frame AND idx IS NOT NULL").count() == 345
