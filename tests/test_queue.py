"""The work queue: timers of a stream, replays of long tasks, one queue for all tasks."""

import time

import pytest
from pyspark.sql import functions as F

from cutweave.operators import ranges
from cutweave.streaming import queue

EVENT = "task_id string, seq long, kind string, dispatch_id string, at double, empty boolean"


@pytest.fixture
def timers(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def put(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").json(str(folder))


def test_a_silent_task_expires_without_an_event_of_its_own(timers, tmp_path):
    """Dispatches of a and b; a result of b; then events of c alone. The expiry of a comes by the clock, b's never does."""
    spark, source = timers, tmp_path / "in"
    put(spark, source, [("a", 1, "dispatch", None, 0.0, None), ("b", 2, "dispatch", None, 0.0, None), ("b", 3, "result", "d1", 1.0, False)])
    found = queue.statuses(spark.readStream.schema(EVENT).json(str(source)), timeout=2.0, retries=1)
    run = found.writeStream.format("memory").queryName("expiries").outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="500 milliseconds").start()
    rows = lambda kind: spark.sql(f"SELECT task_id, dispatch_id, status FROM expiries WHERE kind = '{kind}' ORDER BY seq").collect()
    try:
        end = time.time() + 60
        while time.time() < end and not rows("expiry"):
            time.sleep(0.5)
        assert [tuple(r) for r in rows("expiry")] == [("a", "d1", "timeout_requeued")]
        assert [tuple(r) for r in rows("result")] == [("b", "d1", "received")]
        put(spark, source, [("a", 4, "result", "d1", 9.0, False), ("a", 5, "dispatch", None, 9.0, None), ("c", 6, "dispatch", None, 9.0, None), ("c", 7, "result", "d1", 9.5, True), ("c", 8, "dispatch", None, 9.6, None)])
        end = time.time() + 60
        while time.time() < end and len(rows("expiry")) < 3:
            time.sleep(0.5)
    finally:
        run.stop()
    assert sorted(tuple(r) for r in rows("expiry")) == [("a", "d1", "timeout_requeued"), ("a", "d2", "timeout_retry_exhausted"), ("c", "d2", "timeout_requeued")]
    assert [tuple(r) for r in rows("result")] == [("b", "d1", "received"), ("a", "d1", "stale_ignored"), ("c", "d1", "retry_triggered")]


def test_tasks_of_many_events_keep_their_state_across_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        log = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "short").otherwise("hot").alias("task_id"), F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "dispatch").otherwise("tick").alias("kind"), F.lit(None).cast("string").alias("dispatch_id"), (F.col("id") * 10.0).alias("at"), F.lit(None).cast("boolean").alias("empty"))
        got = queue.replay(log, timeout=15.0, retries=0).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    state = {"short": queue.EMPTY, "hot": queue.EMPTY}
    for r in got:
        state[r.task_id], status, name = queue.step(state[r.task_id], r.kind, None, r.seq * 10.0, False, 15.0, 0, 3)
        assert (r.status, r.dispatch_id) == (status, name)
    assert len(got) == 4000 and sum(r.status == "timeout_requeued" for r in got) > 500


def test_requests_take_the_oldest_entry_of_all_tasks(spark):
    """Requests at 0 and 1 find nothing, a comes back at the tail after c; nothing is left for the last."""
    entries = spark.createDataFrame([("a", 2), ("b", 2), ("c", 4), ("a", 5)], "task_id string, at long")
    requests = spark.createDataFrame([("r0", 0), ("r1", 1), ("r2", 2), ("r3", 6), ("r4", 6), ("r5", 7), ("r6", 8)], "request_id string, at long")
    got = {r.request_id: (r.task_id, r.dispatch_id) for r in queue.served(entries, requests).collect()}
    assert got == {"r0": (None, None), "r1": (None, None), "r2": ("a", "d1"), "r3": ("b", "d1"), "r4": ("c", "d1"), "r5": ("a", "d2"), "r6": (None, None)}
    assert queue.served(entries.limit(0), requests).filter("task_id IS NULL").count() == 7 and queue.served(entries, requests.limit(0)).count() == 0


def test_running_totals_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"), (F.col("id") % 11 - 5).alias("v")).repartition(5)
    for before in (False, True):
        got = {r.x: (r.s, r.m) for r in ranges.running(df, ["x"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, before).collect()}
        total, most = 0, None
        for r in sorted(df.collect()):
            after = (total + r.v, r.v if most is None else max(most, r.v))
            assert got[r.x] == ((total, most) if before else after)
            total, most = after
    assert [r.n for r in ranges.numbered(df, ["x"], "n").orderBy("x").collect()] == list(range(1, 1001))
    assert ranges.running(df.limit(0), ["x"], {"s": ("sum", F.col("v"))}).count() == 0


def test_overdue_dispatches(spark):
    log = [("a", 1, "d1", "dispatched", 0.0), ("a", 2, "d1", "received", 5.0), ("b", 3, "d1", "dispatched", 0.0), ("b", 4, "d1", "timeout_requeued", 30.0), ("c", 5, "d1", "dispatched", 50.0), ("d", 6, "d1", "dispatched", 79.0), ("d", 7, "d9", "stale_ignored", 80.0)]
    got = queue.overdue(spark.createDataFrame(log, "task_id string, seq long, dispatch_id string, status string, at double"), 10.0)
    assert sorted(tuple(r) for r in got.collect()) == [("b", "d1", 0.0, 30.0, "timeout_requeued"), ("c", "d1", 50.0, None, None)]
