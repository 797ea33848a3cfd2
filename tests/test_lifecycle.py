"""Small cases of scans, commits, resumed runs, merges over attempts and jobs."""

import pytest
from pyspark.sql import functions as F

from cutweave.operators import jobs, lifecycle, passes
from cutweave.sources import logs


def test_lines_of_a_file_in_several_splits(spark, tmp_path):
    told = [f'{{"n":{i}}}' if i % 7 else "" for i in range(4000)]
    (tmp_path / "a.jsonl").write_text("\n".join(told) + "\n")
    (tmp_path / "b.jsonl").write_text("x\r\n\r\ny")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = logs.lines(spark, str(tmp_path)).collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    a = {r.line_no: r.line for r in got if r.path.endswith("a.jsonl")}
    assert a == {i: line for i, line in enumerate(told) if line}
    assert {r.line_no: r.line for r in got if r.path.endswith("b.jsonl")} == {0: "x", 2: "y"}


SAMPLE = "subset string, sample_id long, required array<string>, completed array<string>, failure_reason string, was_done boolean"


def test_commits(spark):
    rows = [("s", 1, [" a ", "b", ""], ["b", "a"], None, True), ("s", 2, ["a", "b"], ["b"], " ", False), ("s", 3, ["a"], None, " lost ", None), ("s", 4, None, None, None, None)]
    out = lifecycle.finished(spark.createDataFrame(rows, SAMPLE))
    assert {r.sample_id: (r.outcome, r.missing, r.already_done) for r in out.collect()} == {1: ("done", "", True), 2: ("refused", "a", False), 3: ("failed", "", False), 4: ("done", "", False)}
    before = spark.createDataFrame([("s", 2, "done"), ("s", 3, "done"), ("s", 9, "failed")], "subset string, sample_id long, marker string")
    assert {r.sample_id: r.marker for r in lifecycle.after_commit(before, out).collect()} == {1: "done", 2: "done", 3: "failed", 4: "done", 9: "failed"}


def test_merge_pass_by_attempts(spark):
    sizes = spark.createDataFrame([(i, 4) for i in (1, 2, 3, 4)] + [(5, 1), (6, 0), (7, 4)], "sample_id long, n long")
    asked = {(1, 0): [(0, 1), (2, 3)], (2, 0): [(0, 1), (3, 3)], (2, 1): [(0, 3)], (3, 0): [(0, 0), (1, 1), (2, 2), (3, 3)], (4, 0): [(0, 3)], (4, 1): None}
    attempts = spark.createDataFrame([(s, a, None if r else "timeout") for (s, a), r in asked.items()], "sample_id long, attempt int, problem string")
    ranges = spark.createDataFrame([(s, a, i, x, y) for (s, a), r in asked.items() for i, (x, y) in enumerate(r or [])], "sample_id long, attempt int, ord int, start_id long, end_id long")
    kept = spark.createDataFrame([(4, 0), (4, 1), (4, 2), (1, 9)], "sample_id long, boundary long")
    report, bounds = passes.merge_pass(sizes, attempts, ranges, kept, ratio=0.5, least=2, most=9)
    got = {r.sample_id: (r.valid, r.reason) for r in report.collect()}
    assert got == {1: (1, "applied"), 2: (0, "collapsed_too_aggressively"), 3: (1, "no_merges_selected"), 4: (1, "guard_blocked_all_merges"), 5: (0, "below_min_input_segments"), 6: (0, "empty_input"), 7: (0, "empty_response")}
    assert [(r.sample_id, r.boundary) for r in bounds.collect()] == [(1, 1)]


def test_backends_are_known_by_name(spark):
    df = spark.createDataFrame([("a", 9), ("b", 3)], "task_id string, images int")
    assert {r.task_id: (r.transitions, r.instructions) for r in jobs.scored(df).collect()} == {"a": ([4], ["First step", "Second step"]), "b": ([], ["Single step"])}
    with pytest.raises(ValueError, match="unknown backend"):
        jobs.scored(df, "none")


def test_images_as_text(spark):
    df = spark.createDataFrame([("aGVsbG8=",), ("data:x;base64,aGVs bG8=",), ("data:,",), (None,), ("a",)], "t string")
    data, reason = jobs.image_bytes(F.col("t"))
    assert [(r.d and bytes(r.d), r.r) for r in df.select(data.alias("d"), reason.alias("r")).collect()] == [(b"hello", None), (b"hello", None), (None, "empty_payload"), (None, "empty_payload"), (None, "base64_decode_failed")]
