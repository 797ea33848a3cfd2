"""Commits that die between two steps and are tried again, events in two logs, documents."""

import json

import pytest
from pyspark.sql import functions as F

from cutweave.sources import store

SAMPLE = "subset string, sample_id long, seq long, required array<string>, completed array<string>, failure_reason string, details string, runtime string, segments array<struct<seg_id:int,instruction:string,diagnostics:string>>"
SEGMENT = "seg_id int, instruction string"


def samples(spark, rows):
    return spark.createDataFrame([("s", i, q, ["a"], c, f, None, f"run {q}", [(k, t, "x") for k, t in enumerate(texts)]) for i, q, c, f, texts in rows], SAMPLE)


def shown(spark, base):
    segs = sorted((r.sample_id, r.seg_id, r.instruction) for r in store.payloads(spark, base, SEGMENT).collect())
    marks = {r.sample_id: r.marker for r in store.markers(spark, base).collect()}
    fails = {r.sample_id: r.reason for r in store.reports(spark, base).collect()}
    return segs, marks, fails, {r.sample_id: r.runtime for r in store.runtimes(spark, base).collect()}


FIRST = [(1, 1, ["a"], None, ["old"]), (1, 2, ["a"], None, ["one", "two"]), (2, 3, [], None, ["never"]), (3, 4, ["a"], " lost ", ["gone"])]
SECOND = [(1, 5, ["a"], "late", []), (3, 6, ["a"], "", ["back"]), (4, 7, ["a"], None, [])]


def test_outcomes_of_batches(spark, tmp_path):
    base = str(tmp_path / "store")
    got = {r.sample_id: (r.outcome, r.missing, r.already_done) for r in store.commit(samples(spark, FIRST), base, 0).collect()}
    assert got == {1: ("done", "", False), 2: ("refused", "a", False), 3: ("failed", "", False)}
    assert shown(spark, base) == ([(1, 0, "one"), (1, 1, "two")], {1: "done", 3: "failed"}, {3: "lost"}, {1: "run 2", 3: "run 4"})
    store.commit(samples(spark, SECOND), base, 1)
    after = ([(3, 0, "back")], {1: "failed", 3: "done", 4: "done"}, {1: "late"}, {1: "run 5", 3: "run 6", 4: "run 7"})
    assert shown(spark, base) == after and store.next_batch(spark, base) == 2
    again = store.commit(samples(spark, SECOND), base, 1)
    assert {r.sample_id: r.already_done for r in again.collect()} == {1: False, 3: False, 4: False} and shown(spark, base) == after
    assert {r.sample_id: r.already_done for r in store.commit(samples(spark, SECOND[1:]), base, 2).collect()} == {3: True, 4: True}
    assert [tuple(r) for r in store.progress(spark, base).collect()] == [("s", 2, 1)]
    store.vacuum(spark, base, str(tmp_path / "small"), SEGMENT, 3)
    assert shown(spark, str(tmp_path / "small")) == shown(spark, base) and store.next_batch(spark, str(tmp_path / "small")) == 1
    assert shown(spark, str(tmp_path / "none")) == ([], {}, {}, {})


@pytest.mark.parametrize("dies_at", range(5))
def test_a_batch_that_dies_shows_nothing_and_is_made_good(spark, tmp_path, monkeypatch, dies_at):
    """Five writes a batch: payloads, runtimes, reports, markers, the batch. One that dies before the markers leaves what was there."""
    base, put, writes = str(tmp_path / "store"), store.put, []
    store.commit(samples(spark, FIRST), base, 0)
    before = shown(spark, base)

    def dying(df, path, batch):
        if len(writes) == dies_at:
            raise OSError("lost")
        writes.append(path)
        put(df, path, batch)

    monkeypatch.setattr(store, "put", dying)
    with pytest.raises(OSError, match="lost"):
        store.commit(samples(spark, SECOND), base, 1)
    if dies_at < 4:
        assert shown(spark, base) == before
    monkeypatch.setattr(store, "put", put)
    store.commit(samples(spark, SECOND), base, 1)
    assert shown(spark, base) == ([(3, 0, "back")], {1: "failed", 3: "done", 4: "done"}, {1: "late"}, {1: "run 5", 3: "run 6", 4: "run 7"})


def test_a_stream_of_samples(spark, tmp_path):
    base = str(tmp_path / "store")
    for rows in (FIRST, SECOND):
        samples(spark, rows).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        store.commit_stream(spark.readStream.schema(SAMPLE).json(str(tmp_path / "in")), base, str(tmp_path / "check")).awaitTermination(120)
    assert shown(spark, base)[1] == {1: "failed", 3: "done", 4: "done"} and store.next_batch(spark, base) == 2


EVENT = "event_id long, event string, subset string, sample_id long, stage string, elapsed_ms long"
EVENTS = [(1, "sample_stage_start", "s", 1, "a", None), (2, "sample_stage_done", "s", 1, "a", 7), (3, "sample_stage_done", "t", 2, " ", None), (4, "other", "t", 2, None, None), (5, "sample_failed", "t", 2, None, None)]


def test_events_go_to_both_logs_once(spark, tmp_path, monkeypatch):
    base, put = str(tmp_path / "log"), store.put
    events = spark.createDataFrame(EVENTS, EVENT)

    def dying(df, path, batch):
        raise OSError("lost")

    monkeypatch.setattr(store, "put", dying)
    with pytest.raises(OSError, match="lost"):
        store.append_events(events, base, 0)
    monkeypatch.setattr(store, "put", put)
    for _ in range(2):
        store.append_events(events, base, 0)
    store.append_events(events.filter("event_id = 1").withColumn("event_id", F.lit(9).cast("long")), base, 1)
    for name in ("sample_events", "run_events"):
        got = store.of_ended(spark, base, name).collect()
        assert sorted(r.event_id for r in got) == [1, 2, 4, 9] and {r.event_id: r.subset for r in got} == {1: "s", 2: "s", 4: "t", 9: "s"}
        assert {r.event_id: r.line for r in got}[2] == '{"elapsed_ms":7,"event":"sample_stage_done","sample_id":1,"stage":"a","subset":"s"}'
    assert {r.event_id: r.missing for r in spark.read.parquet(f"{base}/rejected").collect()} == {3: "elapsed_ms,stage", 5: "details,reason"}
    source = str(tmp_path / "in")
    events.coalesce(1).write.json(source)
    store.event_stream(spark.readStream.schema(EVENT).json(source), str(tmp_path / "streamed"), str(tmp_path / "check")).awaitTermination(120)
    assert store.of_ended(spark, str(tmp_path / "streamed"), "run_events").count() == 3


def test_documents_of_runs(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("s", 1, ["x"]), ("t", 2, None)], "subset string, total int, required array<string>")
    store.write_documents(docs, path)
    store.write_documents(docs.filter("subset = 't'").withColumn("total", F.lit(5)), path)
    told = {p.parent.name: json.loads(p.read_text()) for p in (tmp_path / "docs").glob("*/*.txt")}
    assert told == {"__key=s": {"subset": "s", "total": 1, "required": ["x"]}, "__key=t": {"subset": "t", "total": 5}}
