"""Scans over real folders, and percentiles from counts."""

import json
import random

import numpy as np
from pyspark.sql import functions as F

from cutweave.operators import metrics
from cutweave.sources import folders


def test_samples_and_runs(spark, tmp_path):
    for d in ("data/a/one", "data/a/two", "data/b", "runs/a/r1/samples", "runs/b/r1"):
        (tmp_path / d).mkdir(parents=True)
    (tmp_path / "data/a/file.mp4").write_text("no sample")
    (tmp_path / "data/a/one/inner").mkdir()
    sets = [(str(tmp_path / "data"), s) for s in ("a", "b", "missing")]
    samples, runs = folders.data_sets(spark, sets, f"file://{tmp_path}/runs", "r1")
    assert sorted((r.subset, r.sample_id) for r in samples.collect()) == [("a", "one"), ("a", "two")]
    assert {r.subset: r.nonempty for r in runs.collect()} == {"a": True, "b": False, "missing": False}
    assert samples.rdd.getNumPartitions() == 3 and folders.data_sets(spark, [], "x", "y")[0].count() == 0


def test_boundary_files_of_both_shapes(spark, tmp_path):
    ends = lambda *f: [{"end_frame": x} for x in f]
    files = {"p/s1/segments.json": {"segments": ends(10, 20.9, 30)}, "p/s2/segments.json": {"other": 1}, "p/s3/segments.json": {"segments": ends(5)}, "p/s4/segments.json": {"segments": [{}, *ends("7", 8)]}, "o/s1/truth.json": ends(11, 22), "o/s2/truth.json": {"segments": ends(1, 2)}}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(json.dumps(body, indent=1))
    (tmp_path / "p/s5").mkdir()
    (tmp_path / "p/s5/segments.json").write_text("no json")
    rows = lambda df: sorted(tuple(r) for r in df.collect() if True)
    assert rows(folders.boundary_files(spark, str(tmp_path / "p")).na.fill(-1)) == [("s1", 0, 10), ("s1", 1, 20), ("s4", 0, -1), ("s4", 1, 7)]
    assert rows(folders.boundary_files(spark, str(tmp_path / "o"), official=True)) == [("s1", 0, 11)]


def test_percentiles_from_counts(spark):
    rng = random.Random(3)
    values = {m: [rng.choice([1, 2, 2, 9, rng.randrange(1000)]) for _ in range(n)] for m, n in zip(metrics.METRICS, (1, 2, 101, 500), strict=True)}
    rows = [tuple(x if m == k else None for k in metrics.METRICS) for m, v in values.items() for x in v]
    df = spark.createDataFrame(rows, ", ".join(f"{m} long" for m in metrics.METRICS))
    got = {r.metric: r for r in metrics.latencies(df).collect()}
    for m, v in values.items():
        assert (got[m].n, got[m].total, got[m].most) == (len(v), sum(v), max(v))
        assert np.isclose(got[m].p50, np.percentile(v, 50)) and np.isclose(got[m].p95, np.percentile(v, 95))
    assert metrics.latencies(df.filter(F.lit(False))).count() == 0
