"""Rows that steps deal out, and spans that hold points."""

import random

from pyspark.sql import functions as F

from cutweave.functions import text as T
from cutweave.operators import assembly, drift, intervals, passes, wording
from cutweave.plans import catalog
from cutweave.sources import fixtures


def dealt_rows(spark, run):
    """Rows that the shuffles of a run write."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: store.stageList(None, False, False, getattr(store, "stageList$default$4")(), getattr(store, "stageList$default$5")())
    every = lambda: [stages().apply(i) for i in range(stages().size())]
    old = {s.stageId() for s in every()}
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}  # as for large tables
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        run()
    finally:
        for k in conf:
            spark.conf.unset(k)
    return sum(s.shuffleWriteRecords() for s in every() if s.stageId() not in old)


def test_points_in_spans_apart_and_overlapping(spark):
    r = random.Random(3)
    spans = [(k, i, s, s + r.choice([0, 1, 7, 90, 700])) for k in range(4) for i, s in enumerate(r.sample(range(900), 30))] + [(5, 0, None, 9), (None, 0, 0, 9)]
    points = [(k, i, r.randrange(1000)) for k in range(4) for i in range(200)] + [(5, 0, 3), (None, 0, 3), (1, 999, None)]
    made = spark.createDataFrame(points, "k int, p int, at long"), spark.createDataFrame(spans, "k int, i int, s long, e long")
    got = sorted(tuple(x) for x in intervals.holding(*made, ["k"], "at", "s", "e").select("k", "p", "i").collect())
    usable = [x for x in spans if x[2] is not None and x[0] is not None]
    assert got == sorted((k, p, i) for k, p, at in points for q, i, s, e in usable if k == q and at is not None and s <= at < e)


def test_runs_deal_frames_once(spark):
    segments = spark.range(40).select((F.col("id") % 4).alias("sample_id"), (F.floor(F.col("id") / 4) * 900).alias("start_frame"), (F.floor(F.col("id") / 4) * 900 + 900).alias("end_excl"), F.concat(F.lit("Add the salt to the pot "), F.col("id").cast("string")).alias("instruction"))
    timeline = segments.select("sample_id", F.explode(F.sequence("start_frame", F.col("end_excl") - 1)).alias("frame"), F.lit(0).alias("ord"), "instruction")
    described = T.described(segments.select("instruction").distinct())
    rows = dealt_rows(spark, lambda: drift.instruction_runs(segments, timeline, described).collect())
    assert rows < 1.2 * 40 * 900


def test_guards_are_found_once(spark):
    found = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            found.add(b.num_rows)
            yield b

    sizes = spark.createDataFrame([(k, 4) for k in range(6)], "sample_id long, n long")
    attempts = sizes.select("sample_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("attempt"), F.lit(None).cast("string").alias("problem"))
    ranges = attempts.select("sample_id", "attempt", F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit(0).alias("start_id"), F.lit(1).alias("end_id")), F.struct(F.lit(1).alias("ord"), F.lit(2).alias("start_id"), F.lit(3).alias("end_id")))).alias("r")).select("sample_id", "attempt", "r.*")
    guards = lambda within: within.filter("start_idx = 0").select("sample_id", "attempt", F.lit(0).cast("long").alias("boundary")).mapInArrow(seen, "sample_id long, attempt int, boundary long")
    report, bounds = passes.merge_pass(sizes, attempts, ranges, guards, least=2, most=9)
    assert sorted(bounds.groupBy("sample_id").count().collect()) == [(k, 2) for k in range(6)] and report.filter("mode = 'coarse_boundary_consensus'").count() == 6
    assert found.value == 12


def test_texts_are_described_where_the_rows_lie(spark):
    texts = F.array(*[F.lit(f"{v} the onion to the pot") for v in ("Add", "Stir", "Move", "Chop", "Reach for")])
    segments = spark.range(4000).select(
        F.floor(F.col("id") / 8).alias("sample_id"), (F.col("id") % 8).alias("seg_id"), (F.col("id") % 8 * 60).alias("start_frame"), (F.col("id") % 8 * 60 + 60).alias("end_excl"), F.get(texts, (F.col("id") % 5).cast("int")).alias("instruction"),
        F.lit(0.5).alias("confidence"), F.lit(0.4).alias("support_before"), F.lit(0.4).alias("support_after"),
    )
    for run in (wording.merge_tasks, wording.neighbours, assembly.cleaned, lambda s: wording.dominant_texts(s.withColumnRenamed("seg_id", "ord"))):
        assert dealt_rows(spark, lambda run=run: run(segments).collect()) < 1.3 * 4000
    few = wording.glossary(segments)
    many = wording.glossary(segments, most=2)
    assert sorted(map(str, wording.merge_tasks(segments, texts=few).collect())) == sorted(map(str, wording.merge_tasks(segments, texts=many).collect()))


def test_segments_are_dealt_by_sample(spark):
    rows = dealt_rows(spark, lambda: fixtures.segments(spark, "/root/testdata/sf0.001").groupBy("sample_id").agg(F.max("seg_id")).collect())
    assert rows < 2.2 * 6000


def test_policies_describe_texts_once(spark, monkeypatch):
    described, calls = T.described, []
    monkeypatch.setattr(T, "described", lambda *a, **k: calls.append(1) or described(*a, **k))
    found = catalog.QUERIES["sel06_selection_policy"](spark, "/root/testdata/sf0.001")
    assert len(calls) == 1 and found.schema.names == ["sample_id", "policy"]
