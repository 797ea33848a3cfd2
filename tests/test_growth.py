"""Steps whose cost a larger table must not multiply."""

import random

import pytest
from pyspark.sql import functions as F

from cutweave.functions import text as T
from cutweave.operators import assembly, drift, passes, records, windows, wording
from cutweave.plans import catalog
from cutweave.sources import logs
from test_shuffles import dealt_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("every,fps,bin_sec", [(17, 30.0, 2.0), (1, 0.5, 0.1), (90, 30.0, 1.0)])
def test_frames_are_counted_from_the_bounds(spark, every, fps, bin_sec):
    r = random.Random(every)
    made = [(1, i, s, s + r.choice([-5, 0, 1, 60, 61, 90, 91, 1500])) for i, s in enumerate(r.sample(range(-400, 4000), 60))]
    found = windows.frames_by_bin(spark.createDataFrame(made, "sample_id long, seg_id long, start_frame long, end_excl long"), every, F.lit(fps), bin_sec)
    size, want = max(1, round(max(0.5, bin_sec) * max(fps, 1.0))), {}
    for k, i, s, e in made:
        for f in range(s, e, every):
            want[k, i, (f - s) // size] = want.get((k, i, (f - s) // size), 0) + 1
    rows = [tuple(x) for x in found.collect()]
    assert {x[:3]: x[3] for x in rows} == want and len(rows) == len(want)
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["man02_identity_hashes", "map02_reasons_filled"])
def test_dear_rows_are_dealt_to_all_tasks(spark, name):
    assert catalog.QUERIES[name](spark, SF).rdd.getNumPartitions() >= 4


def test_reasons_of_many_fallbacks(spark):
    """As told by the map itself: own reasons stay, blank or missing ones are filled, NULL values and maps are no reasons."""
    r = random.Random(5)
    pick = lambda: {f"s{k}{e}": r.choice([None, "", " ", "true", "TRUE", "why", " so "]) for k in range(40) for e in ("_fallback_used", "_fallback_reason", "_reason") if r.random() < 0.7}
    made = [pick() for _ in range(200)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate([*made, None])], "id int, m map<string,string>")
    said = lambda m, k: (m.get(k) or "").strip()
    for row in df.select("id", records.with_reasons(F.col("m")).alias("got")).collect():
        given = (made[row.id] if row.id < len(made) else None) or {}
        want = dict(given)
        for k, v in given.items():
            stem = k[: -len("_fallback_used")]
            if k.endswith("_fallback_used") and (v or "").lower() == "true" and not said(given, f"{stem}_fallback_reason") and said(given, f"{stem}_reason"):
                want[f"{stem}_fallback_reason"] = said(given, f"{stem}_reason")
        assert row.got == want


@pytest.mark.parametrize("name,most", [("join13_hierarchy", 40_000), ("agg09_consensus", 20_000), ("agg07_merged_ranges", 40_000), ("val07_level_reasons", 28_000),
                                       ("fold05_refined_boundaries", 50_000), ("sel02_refined_texts", 55_000), ("pred09_overcollapsed", 70_000), ("join06_overlaps", 35_000)])
def test_samples_are_not_dealt_again(spark, name, most):
    """Joins by sample and place would deal rows anew that lie by sample already."""
    assert dealt_rows(spark, lambda: catalog.QUERIES[name](spark, SF).collect()) < most


def test_assembly_parses_lines_once_in_all_tasks(spark, monkeypatch):
    """Each query over results that aren't kept would parse all lines again."""
    parse, seen, given = logs.window_results, [], []
    monkeypatch.setattr(logs, "window_results", lambda log, frames: seen.append(log) or parse(log, frames))
    monkeypatch.setattr(assembly, "assembled", lambda results, *a: given.append(results) or results)
    catalog.QUERIES["fold07_assembled"](spark, SF)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert seen[0].rdd.getNumPartitions() >= 4
    assert all("Relation" not in plan(df) and "parse_json" not in plan(df) for df in (seen[0], given[0]))


@pytest.mark.parametrize("name", ["stg01_merge_pass", "sel05_chosen_boundaries", "stg01_merged_spans", "stg04_envelope"])
def test_a_pass_deals_each_segment_once(spark, name):
    """Lines are dealt to their parts twice, for the texts and for the pass, and then by sample; nothing is dealt again, and nothing but texts is kept."""
    assert dealt_rows(spark, lambda: catalog.QUERIES[name](spark, SF).collect()) < 24_000


def test_anchors_of_a_row_are_those_of_a_table(spark):
    r = random.Random(8)
    texts = ["Stir the pot", "Add the salt to the pot", "Chop the onion", "First pour the sauce", "Then pour the sauce", "Wait", None]
    rows = [(s, i, 30 * i, 30 * i + r.randrange(1, 90), r.choice(texts), 0.5, r.choice([None, 0.1, 0.9]), r.choice([None, 0.2, 1.2])) for s in range(5) for i in range(40)]
    segs = spark.createDataFrame(rows, "sample_id long, seg_id long, start_frame long, end_excl long, instruction string, confidence double, support_before double, support_after double")
    cuts = {s: [-1, *sorted(r.sample(range(39), 3)), 39] for s in range(5)}
    ranges = spark.createDataFrame([(s, 0, a + 1, b) for s, c in cuts.items() for a, b in zip(c, c[1:])], "sample_id long, attempt int, start_idx long, end_idx long")
    how = {"spacing": 2, "side": 1}
    want = wording.spaced_anchors(wording.blocked_boundaries(segs, 0.8), ranges.drop("attempt"), least=0.4, **how).select("sample_id", "boundary").collect()
    got = passes.guarded(segs, ranges, True, support=0.8, score=0.4, **how).select("sample_id", "boundary").collect()
    assert sorted(got) == sorted(want) and len(got) > 20


@pytest.mark.parametrize("name,most", [("ses04_instruction_runs", 24_000), ("fold04_best_splits", 24_000), ("fold04_split_segments", 28_000)])
def test_frames_are_never_dealt(spark, name, most):
    """There are some 100,000 labelled frames; lines are dealt to their parts twice, for the texts and for the segments, and then by sample; parts of
    split segments, without frames, once more."""
    assert dealt_rows(spark, lambda: catalog.QUERIES[name](spark, SF).collect()) < most


def slow_runs(spans, frames, described, step):
    """Runs of each span, as instruction_runs() tells them, bin by bin."""
    out = []
    for key, start, end, own in spans:
        bins = {}
        for k, f, o, text in frames:
            if k == key and start <= f < end:
                n, first = bins.setdefault((f - start) // step, {}).get(text, (0, (f, o)))
                bins[(f - start) // step][text] = (n + 1, min(first, (f, o)))
        facts = lambda t: (-described[t].specificity, -len(described[t].ingredients), -len(described[t].families))
        named = [(b, min(x, key=lambda t: (-x[t][0], facts(t), x[t][1]))) for b, x in sorted(bins.items())]
        runs = []
        for b, t in named:
            if not runs or described[runs[-1][-1][1]].signature != described[t].signature:
                runs.append([])
            runs[-1].append((b, t))
        for i, run in enumerate(runs):
            texts = [t for _, t in run]
            text = min(set(texts), key=lambda t: (-texts.count(t), facts(t), texts.index(t)))
            out.append((key, start, i + 1, start + run[0][0] * step, min(start + (run[-1][0] + 1) * step, end), text))
    return sorted(out)


def test_runs_are_those_of_each_bin(spark):
    r = random.Random(6)
    texts = ["Add the salt to the pot", "Add the sugar to the pot", "Add the salt to the big pot", "Stir the onion in the bowl", "Chop the onion", "Wait"]
    spans = [(k, s, s + r.choice([1, 59, 60, 400, 900]), r.choice(texts)) for k in range(6) for s in range(0, 4000, 950)]
    frames = [(k, r.randrange(-50, 5000), i, r.choice(texts[:3] if i % 300 < 150 else texts)) for k in range(7) for i in range(300)]
    d = T.described(spark.createDataFrame([(t,) for t in texts], "instruction string"))
    told = drift.told(d).select("instruction", drift.phase_signature(F.col("t"), F.array().cast("array<string>")).alias("signature"))
    described = {x.instruction: x for x in d.join(told, "instruction").collect()}
    got = drift.instruction_runs(spark.createDataFrame(spans, "sample_id long, start_frame long, end_excl long, instruction string"), spark.createDataFrame(frames, "sample_id long, frame long, ord int, instruction string"), d)
    assert sorted(tuple(x) for x in got.select("sample_id", "start_frame", "run", "run_start", "run_end", "instruction").collect()) == slow_runs(spans, frames, described, 60)
    assert drift.instruction_runs(got.select(*drift.KEYS, "end_excl", "instruction").limit(0), spark.createDataFrame(frames, "sample_id long, frame long, ord int, instruction string"), d).count() == 0
