"""The work queue as event streams: dispatches, results and time-outs of tasks, with fencing and retry budgets.

The same transition serves a batch replay and a stream: state is one small tuple for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.ranges import running

SCHEMA = "task_id string, seq long, kind string, dispatch_id string, status string"
STATE = "current string, since double, accepted string, dispatches long, empties long, timeouts long, closed boolean"
COLUMNS = ["task_id", "seq", "kind", "dispatch_id", "status"]
EMPTY = (None, 0.0, None, 0, 0, 0, False)


def step(state: tuple, kind: str, dispatch: str | None, at: float, empty: bool, timeout: float, retries: int, empty_retries: int) -> tuple[tuple, str, str | None]:
    """(state, status, dispatch id) after one event of a task.

    kinds: dispatch hands the task out under a new id; result brings one back; tick lets time pass. A result counts only under the
    id that is out now; one that was accepted is known again. A limit of 0 retries is none.
    """
    current, since, accepted, dispatches, empties, timeouts, closed = state
    if kind == "dispatch":
        if closed or accepted or current:
            return state, "refused", None
        name = f"d{dispatches + 1}"
        return (name, at, accepted, dispatches + 1, empties, timeouts, closed), "dispatched", name
    if kind == "tick":
        if not current or at - since <= timeout:
            return state, "waiting" if current else "idle", current
        over = 0 < retries < timeouts + 1
        return (None, 0.0, accepted, dispatches, empties, timeouts + 1, closed or over), "timeout_retry_exhausted" if over else "timeout_requeued", current
    if accepted and dispatch == accepted:
        return state, "already_received", dispatch
    if not current or dispatch != current:
        return state, "stale_ignored", dispatch
    if empty:
        over = 0 < empty_retries < empties + 1
        return (None, 0.0, accepted, dispatches, empties + 1, timeouts, closed or over), "empty_retry_exhausted" if over else "retry_triggered", dispatch
    return (None, 0.0, dispatch, dispatches, empties, timeouts, closed), "received", dispatch


def _arrow(columns: list[tuple]):
    import pyarrow as pa

    kinds = [("task_id", pa.string()), ("seq", pa.int64()), ("kind", pa.string()), ("dispatch_id", pa.string()), ("status", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*columns, strict=True), kinds, strict=True)], [n for n, _ in kinds])


def replay(events: DataFrame, timeout: float = 300.0, retries: int = 5, empty_retries: int = 3) -> DataFrame:
    """events(task_id, seq, kind, dispatch_id, at, empty) -> a status for each event, tasks in parallel, a task's events in order.

    Events are sorted by task within partitions and read as they come, with the state of one task at a time: a task may have any
    number of events, and tasks of a few events cost no call of their own.
    """

    def run(batches):
        task, state = None, EMPTY
        for batch in batches:
            out = []
            for t, seq, kind, dispatch, at, empty in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t != task:
                    task, state = t, EMPTY
                state, status, name = step(state, kind, dispatch, at, bool(empty), timeout, retries, empty_retries)
                out.append((t, seq, kind, name, status))
            if out:
                yield _arrow(out)

    ordered = events.select("task_id", "seq", "kind", "dispatch_id", "at", "empty").repartition("task_id").sortWithinPartitions("task_id", "seq")
    return ordered.mapInArrow(run, SCHEMA)


class Tasks(StatefulProcessor):
    """The state of each task and, while a dispatch is out, a timer that fires when its time is over."""

    def __init__(self, timeout: float, retries: int, empty_retries: int):
        self.limits = (timeout, retries, empty_retries)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("task", f"{STATE}, timer long")

    def _put(self, now: tuple, timer: int | None, clock: int) -> None:
        """Keeps the state; a new dispatch sets the timer, an ended one takes it away."""
        if timer is not None and not now[0]:
            self.handle.deleteTimer(timer)
            timer = None
        elif timer is None and now[0]:
            timer = clock + int(self.limits[0] * 1000)
            self.handle.registerTimer(timer)
        self.state.update((*now, timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        *now, timer = tuple(self.state.get()) if self.state.exists() else (*EMPTY, None)
        now, out = tuple(now), []
        for e in pd.concat(list(rows)).sort_values("seq").itertuples():
            before = now[0]
            now, status, name = step(now, e.kind, e.dispatch_id if isinstance(e.dispatch_id, str) else None, e.at, bool(e.empty), *self.limits)
            if before and now[0] != before and timer is not None:  # a later dispatch of the same batch has a timer of its own
                self.handle.deleteTimer(timer)
                timer = None
            out.append((key[0], e.seq, e.kind, name, status))
        self._put(now, timer, timerValues.getCurrentProcessingTimeInMs())
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *now, timer = tuple(self.state.get()) if self.state.exists() else (*EMPTY, None)
        if timer is None or not now[0] or expiredTimerInfo.getExpiryTimeInMs() != timer:
            return  # of a dispatch that has ended
        after, status, name = step(tuple(now), "tick", None, float("inf"), False, *self.limits)
        self.state.update((*after, None))
        yield pd.DataFrame([(key[0], None, "expiry", name, status)], columns=COLUMNS).astype({"seq": "Int64"})

    def close(self) -> None:
        pass


def statuses(events: DataFrame, timeout: float = 300.0, retries: int = 5, empty_retries: int = 3) -> DataFrame:
    """The same over a stream of events, with rows of kind expiry (seq NULL) for dispatches that nothing came back for.

    State is kept by task; a dispatch that is out has a timer on the cluster's clock, so a silent task expires without another
    event of its own. Needs the state store of Spark that keeps timers (RocksDB).
    """
    tasks = events.select("task_id", "seq", "kind", "dispatch_id", "at", "empty").groupBy("task_id")
    return tasks.transformWithStateInPandas(statefulProcessor=Tasks(timeout, retries, empty_retries), outputStructType=SCHEMA, outputMode="Append", timeMode="ProcessingTime")


def overdue(log: DataFrame, timeout: float) -> DataFrame:
    """log(task_id, seq, dispatch_id, status, at) of a replay -> task_id, dispatch_id, at, ended_at, ended: the dispatches that were out for
    longer than timeout, with the status that ended them, or NULL where they are out still and the log goes on beyond their time."""
    own = Window.partitionBy("task_id", "dispatch_id")
    ends = F.col("status").isin("received", "retry_triggered", "empty_retry_exhausted", "timeout_requeued", "timeout_retry_exhausted")
    rows = log.withColumn("end", F.min(F.when(ends, F.struct("seq", "at", "status"))).over(own)).filter("status = 'dispatched'")
    rows = rows.crossJoin(F.broadcast(log.agg(F.max("at").alias("now"))))  # one row
    late = F.coalesce(F.col("end.at"), F.col("now")) - F.col("at") > timeout
    return rows.filter(late).select("task_id", "dispatch_id", "at", F.col("end.at").alias("ended_at"), F.col("end.status").alias("ended"))


def served(entries: DataFrame, requests: DataFrame) -> DataFrame:
    """entries(task_id, at), requests(request_id, at) -> request_id, task_id, dispatch_id: one queue for all tasks, first in, first out.

    A task that comes back is an entry again, at the tail. A request takes the oldest entry that no other took, or NULL where the
    queue is empty; entries come before requests of the same time, ties go by id. dispatch_id counts a task's dispatches. The k-th
    request that is served takes the k-th entry, and those not served are as many as the requests were ever ahead of the entries,
    so all is done by running sums and maxima over ranges of time, never in one task.
    """
    both = entries.select("at", F.lit(0).alias("asks"), F.col("task_id").cast("string").alias("name")).unionByName(requests.select("at", F.lit(1).alias("asks"), F.col("request_id").cast("string").alias("name")))
    order = ["at", "asks", "name"]
    rows = running(both, order, {"n": ("sum", F.lit(1)), "asked": ("sum", F.col("asks"))}).withColumn("ahead", 2 * F.col("asked") - F.col("n"))
    rows = running(rows, order, {"most": ("max", F.col("ahead"))}, before=True).withColumn("empty", F.greatest(F.lit(0), F.col("most"), F.col("ahead")))
    queue = rows.filter("asks = 0").select((F.col("n") - F.col("asked")).alias("k"), F.col("name").alias("task_id"))
    asked = rows.filter("asks = 1").select(F.col("name").alias("request_id"), (F.col("asked") - F.col("empty")).alias("k"), (F.col("ahead") > F.greatest(F.lit(0), F.col("most"))).alias("nothing"))
    turn = F.row_number().over(Window.partitionBy("task_id").orderBy("k"))
    found = asked.filter("NOT nothing").join(queue, "k").select("request_id", "task_id", F.concat(F.lit("d"), turn.cast("string")).alias("dispatch_id"))
    return found.unionByName(asked.filter("nothing").select("request_id"), allowMissingColumns=True)


def event_rates(events: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """events(ts, event) -> window start, event, n; in a stream, events later than late are dropped."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", window).alias("w"), "event").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event", "n")


def sessions(events: DataFrame, gap: str = "5 minutes", late: str = "30 minutes") -> DataFrame:
    """events(ts, sample_id) -> sample_id, first and last time of each run of events with gaps of at most gap, and their number."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    out = e.groupBy(F.session_window("ts", gap), "sample_id").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    return out.select("sample_id", "first", "last", "n")


def first_of_each(events: DataFrame, late: str = "30 minutes") -> DataFrame:
    """One row for each (task_id, dispatch_id), the first by seq: later copies are dropped. In a stream, the first that arrives."""
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["task_id", "dispatch_id"])
    return events.groupBy("task_id", "dispatch_id").agg(F.min_by(F.struct(*events.columns), "seq").alias("e")).select("e.*")
