"""Small cases with known answers."""

from pyspark.sql import functions as F

from cutweave.functions import scalars, text
from cutweave.operators import evaluate, metrics, segments, votes, windows, wording
from cutweave.sources import logs, sinks
from cutweave.streaming import queue


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def scored(spark, truth, predicted, tolerance):
    g = spark.createDataFrame([(1, i, f) for i, f in enumerate(truth)] or [(2, 0, 0)], "sample_id long, idx long, frame long").filter("sample_id = 1")
    p = spark.createDataFrame([(1, f) for f in predicted], "sample_id long, frame long")
    return sorted(evaluate.matches(g, p, tolerance).collect(), key=lambda r: r.idx), evaluate.recall(g, p, tolerance).first()


def test_boundary_recall(spark):
    m, s = scored(spark, [100, 200], [10, 97, 102, 150, 198, 201, 250], 5)
    assert (s.hit_count, s.recall, s.pred_count) == (2, 1.0, 7)
    m, s = scored(spark, [100, 200, 300], [96, 209, 305], 5)
    assert [r.hit for r in m] == [True, False, True] and [r.delta for r in m] == [-4, 9, 5]
    m, _ = scored(spark, [100, 104], [102], 3)
    assert [r.hit for r in m] == [True, False] and m[0].pred_frame == 102
    m, _ = scored(spark, [104, 100], [102, 97], 3)
    assert [r.pred_frame for r in m] == [102, 97] and [r.delta for r in m] == [-2, -3]
    m, s = scored(spark, [], [5], 5)
    assert m == [] and s.recall == 0.0 and s.mean_delta is None


def clustered(spark, rows):
    df = spark.createDataFrame([(1, f, float(w)) for f, w in rows], "sample_id long, frame long, weight double")
    return {r.point: r.support for r in votes.clusters(df, 30.0).collect()}


def test_cut_clusters(spark):
    assert clustered(spark, [(100, 1), (120, 1), (145, 1), (170, 1), (195, 1)]) == dict.fromkeys([100, 120, 145, 170, 195], 1.0)
    assert clustered(spark, [(200, 0.5), (202, 1), (204, 0.25), (212, 0.75)]) == {202: 1.75, 212: 0.75}
    assert set(clustered(spark, [(1089, 0.99), (1111, 0.08)])) == {1089, 1111}


def voted(spark, repeats):
    rows = [(1, 0, r, 2 * i) for r, at in enumerate(repeats) for i in at]
    df = spark.createDataFrame(rows, "sample_id long, window_id long, repeat_index long, frame long")
    usable = spark.createDataFrame([(1, 0, len(repeats))], "sample_id long, window_id long, total long")
    return {r.frame // 2: round(r.support, 3) for r in votes.repeat_votes(df, usable, 30.0).collect()}


def test_repeat_votes(spark):
    assert voted(spark, [[5], [5], [9]]) == {5: 0.667, 9: 0.333}
    assert voted(spark, [[5, 6], [5], []]) == {5: 0.667}
    assert voted(spark, [[5], [], []]) == {5: 0.333} and voted(spark, [[5, 6]]) == {5: 1.0, 6: 1.0}


def test_text_sources(spark):
    rows = [(1, 0, 0, [10], 2), (1, 0, 1, [50], 2), (1, 0, 2, [52, 90], 3), (2, 0, 0, [5, 9], 3), (2, 0, 1, [], 1), (3, 0, 4, [], 1)]
    records = spark.createDataFrame(rows, "sample_id long, window_id long, repeat_index long, frames array<long>, texts int")
    cuts = spark.createDataFrame([(1, 0, 50), (3, 0, 7)], "sample_id long, window_id long, frame long")
    got = {r.sample_id: r.repeat_index for r in votes.text_sources(records, cuts, 30.0).collect()}
    assert got == {1: 1, 2: 1, 3: 4}


def test_boundaries_with_a_reason(spark):
    rows = [(1, 0, 0, 0, "Add the first potato", 0.1), (1, 1, 0, 9, "Add the second potato", 0.1), (1, 2, 9, 20, "Add the second potato", 0.9), (1, 3, 20, 30, "Add the second potato", None)]
    s = spark.createDataFrame([(i, g, a, b, t, 1.0, None, u) for i, g, a, b, t, u in rows], "sample_id long, seg_id long, start_frame long, end_excl long, instruction string, confidence double, support_before double, support_after double")
    got = {r.seg_id: r for r in wording.blocked_boundaries(s, 0.45).collect()}
    assert set(got) == {0, 2} and got[2].reasons == "support" and got[2].score == 0.9
    assert got[0].reasons == "sequence" and got[0].round_only and got[0].score == 0.1 and got[0].shorter == 1
    assert set(r.seg_id for r in wording.blocked_boundaries(s, 0.45, by_markers=False).collect()) == {2}


def test_windows(spark):
    assert one(spark, windows.chunks(F.array(*[F.lit(i) for i in range(10)]), 4)) == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    w = spark.createDataFrame([(1, 0, 0, 119, 1000)], "sample_id long, window_id long, start_frame long, end_incl long, nframes long")
    assert [(r.window_id, r.start_frame, r.end_incl) for r in windows.refinement_windows(w, 10.0).orderBy("window_id").collect()] == [(1000000, 0, 59), (1000001, 30, 89), (1000002, 60, 119)]
    s = spark.createDataFrame([(1, 0, 0, 100), (1, 1, 100, 220)], "sample_id long, seg_id long, start_frame long, end_excl long")
    clip = windows.boundary_clips(s, spark.createDataFrame([(1, 25.0, 400)], "sample_id long, fps double, nframes long"), 4.0, 12).collect()
    assert len(clip) == 1 and clip[0].start_frame < 100 < clip[0].end_incl and len(clip[0].frame_ids) == 12
    long = windows.hop_windows(spark.createDataFrame([(1, 30.0, 4501), (2, 0.0, 0), (3, 30.0, 5)], "sample_id long, fps double, nframes long"))
    assert {r["sample_id"]: r["count"] for r in long.groupBy("sample_id").count().collect()} == {1: 25, 3: 1}


def pair(spark, left, right):
    return wording.paired(spark.createDataFrame([(left, right)], "a string, b string"), "a", "b")


def test_drift_and_markers(spark):
    assert pair(spark, "Add potatoes to the pot", "Stir the pot").select(text.drifts("l_", "r_").alias("x")).first().x
    assert pair(spark, "First add salt", "Next add salt").select(text.distinct_markers(F.col("l_markers"), F.col("r_markers")).alias("x")).first().x


def test_support_between(spark):
    support, known = segments.support_between(F.lit(0.25), F.lit(0.75))
    assert one(spark, support) == 0.75 and one(spark, known)
    support, known = segments.support_between(F.lit(None).cast("double"), F.lit(None).cast("double"))
    assert one(spark, support) == 0.0 and not one(spark, known)


def merged(spark, rows, threshold=0.9):
    df = spark.createDataFrame([(1, i, a, b, t, 1.0, x, y) for i, (a, b, t, x, y) in enumerate(rows)], "sample_id long, seg_id long, start_frame long, end_excl long, instruction string, confidence double, support_before double, support_after double")
    return [(r.start_frame, r.end_excl) for r in wording.merge_tasks(df, 30.0, threshold).orderBy("seg_id").collect()]


def test_strong_boundaries_stay(spark):
    pours = [(0, 90, "First pour of the sauce into the pan", None, 1.1), (90, 180, "Second pour of the sauce into the pan", 1.1, None)]
    assert merged(spark, pours) == [(0, 90), (90, 180)]


def test_near_movements_of_one_object_merge(spark):
    bowl = [(0, 111, "Adjust the bowl on the table", None, None), (111, 541, "Move the bowl to the tray", None, None), (541, 621, "Adjust the bowl on the tray", None, None)]
    assert merged(spark, bowl) == [(0, 621)]


def test_results_are_checked(spark):
    def check(body, last=None, allowed=None):
        r = one(spark, logs.checked(F.try_parse_json(F.lit(body)), last, allowed))
        return r and (r.thought, r.transitions, r.instructions)

    assert check('{"transitions":[0],"instructions":["a","b"]}') is None
    assert check('{"transitions":[3],"instructions":["a"," b "]}', None, F.array(*[F.lit(i) for i in range(2, 6)])) == ("", [3], ["a", "b"])
    assert check('{"transitions":["3", 4.9],"instructions":["a","b","c"]}', 4) == ("", [3, 4], ["a", "b", "c"])
    assert check('{"transitions":[true],"instructions":["a","b"]}') == ("", [1], ["a", "b"])
    for bad in ("[]", "{}", '{"instructions":[1]}', '{"instructions":[]}', '{"transitions":[2,2],"instructions":["a","b","c"]}', '{"transitions":"x","instructions":["a"]}', '{"transitions":[5],"instructions":["a","b"]}'):
        assert check(bad, 4) is None, bad


def test_partitions(spark):
    def reason(ranges, n=4):
        r = spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate(ranges)] or [(9, 0, 0, 0)], "sample_id long, ord int, start_id long, end_id long").filter("sample_id = 1")
        return segments.partition_reasons(r, spark.createDataFrame([(1, n)], "sample_id long, n long"), 0.25).first().reason

    assert reason([(0, 1), (3, 3)]) == "invalid_partition" and reason([(0, 3)]) == "ok" and reason([]) == "invalid_merged_ranges" and reason([(0, 1)]) == "incomplete_partition"


def test_nesting(spark):
    make = lambda rs: spark.createDataFrame([(1, a, b) for a, b in rs], "sample_id long, start_idx long, end_idx long")
    assert segments.nesting_violations(make([(0, 1), (2, 3)]), make([(0, 2), (3, 3)])).count() == 1


def test_captions_wrap(spark):
    assert one(spark, scalars.wrapped(F.lit("put the red bowl on the small tray"))) == "put the red bowl\non the small tray"
    assert one(spark, scalars.wrapped(F.lit("x" * 40))).split("\n") == ["x" * 18, "x" * 18, "x" * 4]
    assert one(spark, scalars.wrapped(F.lit("  "))) == ""


EVENTS = [("dispatch", None, 0.0, False), ("result", "d9", 1.0, False), ("tick", None, 400.0, False), ("result", "d1", 401.0, False), ("dispatch", None, 402.0, False), ("result", "d2", 403.0, True), ("dispatch", None, 404.0, False), ("result", "d3", 405.0, False), ("result", "d3", 406.0, False), ("dispatch", None, 407.0, False)]
STATUSES = ["dispatched", "stale_ignored", "timeout_requeued", "stale_ignored", "dispatched", "retry_triggered", "dispatched", "received", "already_received", "refused"]
LOG = "task_id string, seq long, kind string, dispatch_id string, at double, empty boolean"


def test_queue_in_batch_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(f"t{t}", i, *e) for t in range(3) for i, e in enumerate(EVENTS)], LOG)
    batch = sorted((r.task_id, r.seq, r.status) for r in queue.replay(df).collect())
    assert [s for t, _, s in batch if t == "t1"] == STATUSES
    df.coalesce(1).write.json(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = queue.statuses(spark.readStream.schema(LOG).json(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("statuses").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted((r.task_id, r.seq, r.status) for r in spark.table("statuses").collect()) == batch


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("segment_label", "y"), ("boundary_refinement", "z")], "job_type string, v string")
    for _ in range(2):
        sinks.append_results(rows, str(tmp_path / "r"))
    assert {r["job_type"]: r["count"] for r in spark.read.json(str(tmp_path / "r")).groupBy("job_type").count().collect()} == {"window": 2, "segment_label": 2, "boundary_refinement": 2}
    s = spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], "sample_id long, seg_id long, instruction string")
    sinks.overwrite_payloads(s, str(tmp_path / "p"))
    sinks.overwrite_payloads(s.filter("sample_id = 1").withColumn("instruction", F.lit("new")), str(tmp_path / "p"), 256)
    many = spark.range(40).select(F.col("id").alias("sample_id"), F.lit(0).cast("long").alias("seg_id"), F.lit("x").alias("instruction"))
    sinks.overwrite_payloads(many, str(tmp_path / "q"), 4)
    sinks.overwrite_payloads(many.filter("sample_id = 7").withColumn("instruction", F.lit("new")), str(tmp_path / "q"), 4)
    assert len(list((tmp_path / "q").glob("bucket=*"))) == 4 and spark.read.parquet(str(tmp_path / "q")).filter("instruction = 'new'").count() == 1 and spark.read.parquet(str(tmp_path / "q")).count() == 40
    assert sorted(r.instruction for r in spark.read.parquet(str(tmp_path / "p")).collect()) == ["new", "y"]


def test_log_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "w.jsonl").write_text('{"window_id":1}\nbad\n\n{"window_id":1,"terminal_error":"e"}\n')
    got = logs.lines(spark, str(tmp_path / "w.jsonl"))
    assert [r.line_no for r in got.collect()] == [0, 1, 3]
    assert [r.error for r in logs.window_results(got.withColumn("sample_id", F.lit(1)), 12).collect()] == ["e"]


def test_export_states(spark):
    def state(required, enabled, attempted, reason, failed):
        return one(spark, metrics.export_status(F.lit(required), F.lit(enabled).cast("boolean"), F.lit(attempted).cast("boolean"), F.lit(reason), F.lit(failed)))

    assert [state(True, None, None, "applied", False), state(True, None, None, None, True), state(False, None, None, "", False), state(True, True, False, "", False)] == ["applied", "failed", "disabled", "not_attempted"]
