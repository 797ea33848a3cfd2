"""Roll-ups of event logs and runtime records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Event names and the fields each must have.
_TASK = ["task_id", "subset", "sample_id", "job_type"]
_SENT = ["task_id", "dispatch_id", "subset", "sample_id", "job_type"]
REQUIRED = {
    "artifact_extract_done": [*_TASK, "image_count", "artifact_extract_ms", "transport_mode", "artifact_reuse"],
    "artifact_reuse_hit": [*_TASK, "artifact_reuse", "artifact_reuse_group", "artifact_producer_task_id", "artifact_consumer_task_id"],
    "job_dispatched": [*_SENT, "source_count", "transport_mode", "artifact_reuse"],
    "infer_attempt": [*_SENT, "infer_ms"],
    "job_done": [*_SENT, "infer_ms", "submit_ms"],
    "result_empty_retry": [*_SENT, "attempt", "retry_limit", "infer_ms", "submit_ms"],
    "result_timeout_retry": [*_SENT, "attempt", "retry_limit"],
    "sample_stage_start": ["subset", "sample_id", "stage"],
    "sample_stage_done": ["subset", "sample_id", "stage", "elapsed_ms"],
    "fallback_applied": ["subset", "sample_id"],
    "sample_failed": ["subset", "sample_id", "reason", "details"],
    "finalize_done": ["subset", "sample_id", "finalize_ms", "segment_count"],
}
IDENTIFIERS = ["subset", "sample_id", "stage", "job_type", "task_id", "dispatch_id"]
METRICS = ["artifact_extract_ms", "infer_ms", "submit_ms", "finalize_ms"]
FAILED_EXPORTS = ["failed", "failed_before_export_completion", "partial_failure"]


def count_of(value: Column) -> Column:
    """A whole number of at least 0; 0 for what is none."""
    return F.greatest(F.lit(0).cast("long"), F.coalesce(value.try_cast("bigint"), F.lit(0).cast("long")))


def timing(events: DataFrame) -> DataFrame:
    """events(sample_id, event, ts, ts_unix_ms, stage, elapsed_ms, ...) -> per sample: first and last time with their texts, the time
    between, event counts by name and totals of the jobs' milliseconds. Events without a name are skipped."""
    e = events.filter(F.trim(F.coalesce("event", F.lit(""))) != "")
    total = lambda names, field: F.sum(F.when(F.col("event").isin(*names), count_of(F.col(field))).otherwise(0)).cast("long")
    at = F.col("ts_unix_ms")
    out = e.groupBy("sample_id").agg(
        F.min(at).alias("first_ms"), F.max(at).alias("last_ms"), F.min_by("ts", F.when(at.isNotNull(), at)).alias("first_at"), F.max_by("ts", F.when(at.isNotNull(), at)).alias("last_at"), F.count("*").alias("events"),
        total(["artifact_extract_done"], "artifact_extract_ms").alias("extract_total"), total(["infer_attempt"], "infer_ms").alias("infer_total"), total(["job_done", "result_empty_retry"], "submit_ms").alias("submit_total"), total(["finalize_done"], "finalize_ms").alias("finalize_total"),
    )
    return out.withColumn("total_elapsed_ms", F.coalesce(F.greatest(F.lit(0).cast("long"), F.col("last_ms") - F.col("first_ms")), F.lit(0).cast("long"))).drop("first_ms", "last_ms")


def stage_times(events: DataFrame) -> DataFrame:
    """Milliseconds of each sample's finished stages."""
    return events.filter("event = 'sample_stage_done' AND trim(stage) <> ''").groupBy("sample_id", "stage").agg(F.sum(count_of(F.col("elapsed_ms"))).cast("long").alias("elapsed_ms"))


def event_counts(events: DataFrame) -> DataFrame:
    return events.filter("trim(event) <> ''").groupBy("sample_id", "event").agg(F.count("*").alias("n"))


def latencies(events: DataFrame) -> DataFrame:
    """metric, n, total, p50, p95, most of each of the four latencies over all events that have one.

    What moves and is held is a count for each millisecond that occurs, not each value; percentiles lie between two of these.
    """
    rows = events.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("ms")) for m in METRICS])).alias("x")).select("x.*").filter("ms IS NOT NULL")
    counts = rows.groupBy("metric", "ms").agg(F.count("*").alias("c"))
    w = Window.partitionBy("metric")
    counts = counts.withColumns({"upto": F.sum("c").over(w.orderBy("ms")), "n": F.sum("c").over(w)})

    def at(share: float):
        place = (F.first("n") - 1) * share  # from 0
        value = lambda k: F.min(F.when(F.col("upto") > k, F.col("ms")))
        low, high = value(F.floor((F.col("n") - 1) * share)), value(F.ceil((F.col("n") - 1) * share))
        return low + (high - low) * (place - F.floor(place))

    return counts.groupBy("metric").agg(F.sum("c").alias("n"), F.sum(F.col("ms") * F.col("c")).cast("long").alias("total"), at(0.5).alias("p50"), at(0.95).alias("p95"), F.max("ms").alias("most"))


# The events that tell of a retry or of a fallback.
REPEATED = {"result_empty_retry": "empty_retries", "result_timeout_retry": "timeout_retries", "fallback_applied": "fallbacks"}


def repeats(events: DataFrame) -> DataFrame:
    """subset, empty_retries, timeout_retries, retries (both), fallbacks; subsets without any have none."""
    of = events.filter(F.col("event").isin(*REPEATED)).groupBy("subset").agg(*[F.count_if(F.col("event") == e).alias(c) for e, c in REPEATED.items()])
    return of.select("subset", "empty_retries", "timeout_retries", (F.col("empty_retries") + F.col("timeout_retries")).alias("retries"), "fallbacks")


def contract_violations(events: DataFrame) -> DataFrame:
    """event_id, missing: the required fields that an event lacks, in the order of their names; identifiers that are blank lack too, and
    so do fields that the table has no column for. Events of other names are not checked."""
    there = set(events.columns)

    def lacks(field: str) -> Column:
        absent = F.lit(True) if field not in there else F.col(field).isNull() | ((F.trim(F.col(field).cast("string")) == "") if field in IDENTIFIERS else F.lit(False))
        return F.when(F.col("event").isin(*[e for e, f in REQUIRED.items() if field in f]) & absent, F.lit(field))

    lacking = [lacks(field) for field in sorted({f for fs in REQUIRED.values() for f in fs})]
    return events.withColumn("__missing", F.array_join(F.array_compact(F.array(*lacking)), ",")).filter("__missing <> ''").select("event_id", F.col("__missing").alias("missing"))


def export_status(required: Column, enabled: Column, attempted: Column, reason: Column, failed: Column) -> Column:
    """The state of an export from what is recorded; NULL switches take their defaults."""
    reason = F.trim(F.coalesce(reason, F.lit("")))
    return (
        F.when(reason == "applied", "applied").when(failed | reason.isin(*FAILED_EXPORTS), "failed").when(~F.coalesce(enabled, required), "disabled")
        .when(required & ~F.coalesce(attempted, failed), "not_attempted").when(~required, "not_required").otherwise("unknown")
    )


def runtime_records(state: DataFrame) -> DataFrame:
    """state(sample_id, terminal_state, required, completed, total_retries, empty_retries, timeout_retries, dispatches, export_*,
    failure_reason) -> the same with stage names trimmed and distinct, pending stages, counters of at least 0, dispatches inferred
    from the retries where none is known, and the export's status."""
    names = lambda c: F.array_distinct(F.filter(F.transform(c, lambda s: F.trim(s)), lambda s: s != ""))
    out = state.withColumns({"required": names("required"), "completed": names("completed")})
    ended = F.trim(F.coalesce("terminal_state", F.lit("")))
    retries, sent = count_of(F.col("total_retries")), count_of(F.col("dispatches"))
    needs = F.array_contains("required", "export")
    return out.select(
        "sample_id", F.coalesce(F.nullif(ended, F.lit("")), F.lit("unknown")).alias("terminal_state"), "required", "completed", F.array_except("required", "completed").alias("pending"), retries.alias("total_retries"),
        count_of(F.col("empty_retries")).alias("empty_retries"), count_of(F.col("timeout_retries")).alias("timeout_retries"), F.when(sent > 0, sent).when(ended != "", retries + 1).otherwise(F.lit(0).cast("long")).alias("dispatches"),
        export_status(needs, F.col("export_enabled"), F.col("export_attempted"), F.col("export_reason"), F.coalesce(F.col("failure_reason") == "export_failed", F.lit(False))).alias("export_status"), F.trim(F.coalesce("failure_reason", F.lit(""))).alias("failure_reason"),
    )


def run_summary(samples: DataFrame, records: DataFrame) -> DataFrame:
    """section, name, n: samples by state (pending without a record), stages completed and missing, retries, exports and failures.

    One pass: each sample gives its facts as rows, and one aggregate counts them.
    """
    joined = samples.join(records, "sample_id", "left")
    fact = lambda section, name, n=None: F.struct(F.lit(section).alias("section"), name.alias("name"), (F.lit(1).cast("long") if n is None else n).alias("n"))
    stages = lambda section, c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda s: fact(section, s))
    facts = F.concat(
        F.array(fact("state", F.coalesce("terminal_state", F.lit("pending"))), fact("export", F.col("export_status")), fact("failure", F.nullif("failure_reason", F.lit("")))),
        F.array(*[fact("retry", F.lit(c), F.coalesce(F.col(c), F.lit(0).cast("long"))) for c in ("total_retries", "empty_retries", "timeout_retries", "dispatches")]),
        stages("stage_completed", F.array_intersect("required", "completed")), stages("stage_missing", F.col("pending")),
    )
    return joined.select(F.explode(facts).alias("f")).select("f.*").filter("name IS NOT NULL").groupBy("section", "name").agg(F.sum("n").cast("long").alias("n"))
