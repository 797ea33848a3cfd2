"""The life of a sample in a run: required stages, retries, commits, reconciled records and resumed manifests.

All of it is joins and column expressions keyed by (subset, sample_id), so samples are decided in parallel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["subset", "sample_id"]
# Fields that identify a run, and stages in the order in which switches add them.
IDENTITY = ["schema_version", "deployment_mode", "run_id", "subset", "data_root", "config_hash", "prompt_hash", "git_version", "backend_summary", "required_stages"]
FIRST_STAGE, TEXT_STAGE, EXPORT_STAGE = "stage1_segments", "stage2_text", "export"
STRINGS = "array<string>"


def stage_names(names: Column) -> Column:
    """Trimmed names in order of first sight, without blanks and repeats; NULL counts as none."""
    trimmed = F.transform(F.coalesce(names, F.array().cast(STRINGS)), lambda s: F.trim(s))
    return F.array_distinct(F.filter(trimmed, lambda s: s != ""))


def required_stages(stated: Column, text: Column, export: Column) -> Column:
    """The stages that a manifest states, trimmed and without blanks, else those of the switches."""
    named = F.filter(F.transform(stated, lambda s: F.trim(s)), lambda s: s != "")
    by_switch = F.array_compact(F.array(F.lit(FIRST_STAGE), F.when(text, F.lit(TEXT_STAGE)), F.when(export, F.lit(EXPORT_STAGE))))
    return F.coalesce(named, by_switch)


def with_export_defaults(diagnostics: Column, required: Column, completed: Column) -> Column:
    """The map with an applied export, where export is required and completed and no key tells of one."""
    given = F.coalesce(diagnostics, F.create_map().cast("map<string,string>"))
    told = F.exists(F.map_keys(given), lambda k: k.startswith("export_"))
    has = lambda c: F.array_contains(stage_names(c), EXPORT_STAGE)
    added = F.create_map(*[F.lit(x) for x in ("export_enabled", "true", "export_attempted", "true", "export_reason", "applied")])
    return F.when(has(required) & has(completed) & ~told, F.map_concat(given, added)).otherwise(given)


def retry_counters(stored: DataFrame, retries: DataFrame) -> DataFrame:
    """stored(subset, sample_id, total_retries, empty_retries, timeout_retries, dispatches), retries(subset, sample_id, field) -> the
    counters after these retries: stored ones go on from what they were, and the total of a sample that retried is the sum of both."""
    new = retries.groupBy(*KEY).agg(*[F.count_if(F.col("field") == f).alias(f"new_{f}") for f in ("empty_retries", "timeout_retries")])
    both = stored.join(new, KEY, "full")
    zero = F.lit(0).cast("long")
    of = lambda c: F.coalesce(F.col(c).cast("long"), zero)
    empty, late = of("empty_retries") + of("new_empty_retries"), of("timeout_retries") + of("new_timeout_retries")
    bumped = of("new_empty_retries") + of("new_timeout_retries") > 0
    return both.select(*KEY, F.when(bumped, empty + late).otherwise(of("total_retries")).alias("total_retries"), empty.alias("empty_retries"), late.alias("timeout_retries"), of("dispatches").alias("dispatches"))


def structured_events(events: DataFrame, at: Column) -> DataFrame:
    """Events of a known sample as JSON lines with their time: rows with a blank subset or sample are dropped, fields without a value
    left out. at is the time of an event as a timestamp."""
    known = events.filter((F.trim(F.coalesce(F.col("subset").cast("string"), F.lit(""))) != "") & (F.trim(F.coalesce(F.col("sample_id").cast("string"), F.lit(""))) != ""))
    timed = known.withColumns({"ts": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS"), "ts_unix_ms": F.unix_millis(at)})
    line = F.to_json(F.struct(*[F.col(c) for c in sorted(timed.columns)]), {"ignoreNullFields": "true"})
    return timed.select(*KEY, line.alias("line"))


def finished(samples: DataFrame) -> DataFrame:
    """samples(subset, sample_id, required, completed, failure_reason, was_done) -> subset, sample_id, outcome, missing, already_done.

    A failure reason that isn't blank makes it failed; then done if no required stage is missing, else refused, with the missing
    stages in their order. already_done tells whether a sample that is done now has been so before.
    """
    missing = F.array_except(stage_names(F.col("required")), stage_names(F.col("completed")))
    failed = F.trim(F.coalesce("failure_reason", F.lit(""))) != ""
    outcome = F.when(failed, "failed").when(F.size(missing) == 0, "done").otherwise("refused")
    return samples.select(*KEY, outcome.alias("outcome"), F.array_join(F.when(failed, F.array().cast(STRINGS)).otherwise(missing), ", ").alias("missing"), ((outcome == "done") & F.coalesce("was_done", F.lit(False))).alias("already_done"))


def after_commit(markers: DataFrame, outcomes: DataFrame) -> DataFrame:
    """markers(subset, sample_id, marker) -> the markers after the commit of outcomes: done and failed replace what a sample had, a
    refused one keeps it."""
    new = outcomes.filter("outcome <> 'refused'").select(*KEY, F.col("outcome").alias("marker"))
    return markers.join(new, KEY, "left_anti").select(*KEY, "marker").unionByName(new)


def sample_states(samples: DataFrame, markers: DataFrame, open_jobs: DataFrame) -> DataFrame:
    """samples(subset, sample_id, planned), markers, open_jobs(subset, sample_id, ...) -> subset, sample_id, state: 4 failed, 3 done,
    2 finalizing (all planned and no open job), 0 producing. A subset's samples need no order here: they don't depend on each other."""
    open_ = open_jobs.groupBy(*KEY).agg(F.count("*").alias("jobs"))
    joined = samples.join(markers, KEY, "left").join(open_, KEY, "left")
    state = F.when(F.col("marker") == "failed", 4).when(F.col("marker") == "done", 3).when(F.col("planned") & F.col("jobs").isNull(), 2).otherwise(0)
    return joined.select(*KEY, state.alias("state"))


def open_jobs(queue: DataFrame, failures: DataFrame) -> DataFrame:
    """The jobs of a queue whose sample has not failed: a failed one loses its queued jobs, those under way and their counters."""
    return queue.join(failures.select(*KEY).distinct(), KEY, "left_anti")


def reconciled(markers: DataFrame, runtimes: DataFrame, payloads: DataFrame, reports: DataFrame, stages: DataFrame) -> DataFrame:
    """Runtime records that a resumed run has to write again: of samples with a marker whose record is missing or tells another state.

    markers(subset, sample_id, done, failed), runtimes(subset, sample_id, terminal_state), payloads(subset, sample_id, diagnostics,
    required, completed) of done samples, reports(subset, sample_id, reason, required, completed), stages(subset, required). Done goes
    before failed. Stages that are not stated are the subset's; a done sample has completed what it required, a failed one nothing.
    """
    done, failed, state = F.coalesce("done", F.lit(False)), F.coalesce("failed", F.lit(False)), F.trim(F.coalesce("terminal_state", F.lit("")))
    right = (done & (state == "done")) | (failed & (state == "failed"))
    stale = markers.join(runtimes, KEY, "left").filter((done | failed) & ~right).select(*KEY, done.alias("is_done"))
    named = lambda df, p: df.select(*KEY, *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in KEY])
    rows = stale.join(named(payloads, "p"), KEY, "left").join(named(reports, "r"), KEY, "left").join(stages.select("subset", F.col("required").alias("of_subset")), "subset", "left")
    required = F.when(F.col("is_done"), F.coalesce("p_required", "of_subset")).otherwise(F.coalesce("r_required", "of_subset"))
    completed = F.when(F.col("is_done"), F.coalesce("p_completed", required)).otherwise(F.coalesce("r_completed", F.array().cast(STRINGS)))
    diagnostics = F.when(F.col("is_done"), with_export_defaults(F.col("p_diagnostics"), required, completed)).otherwise(F.create_map().cast("map<string,string>"))
    reason = F.when(F.col("is_done"), "").otherwise(F.trim(F.coalesce("r_reason", F.lit(""))))
    return rows.select(*KEY, F.when(F.col("is_done"), "done").otherwise("failed").alias("terminal_state"), required.alias("required"), completed.alias("completed"), diagnostics.alias("diagnostics"), reason.alias("failure_reason"))


def manifest_actions(runs: DataFrame, force: Column) -> DataFrame:
    """runs(subset, current, existing, readable, nonempty) with two structs of the fields of IDENTITY; existing is NULL where there is no
    manifest, readable tells whether one that is there can be read -> subset, action, mismatches.

    Actions: created_fresh_manifest, validated_existing_manifest, refused, and with force force_resume_rebuilt_missing_manifest (a
    folder with results and no manifest) or force_resume_overrode_identity_mismatch.
    """
    differs = F.array_compact(F.array(*[F.when(~F.col(f"existing.{n}").eqNullSafe(F.col(f"current.{n}")), F.lit(n)) for n in IDENTITY]))
    none, absent = F.array().cast(STRINGS), F.col("existing").isNull() & F.col("readable").isNull()
    mismatches = F.when(absent, F.when(F.col("nonempty"), F.array(F.lit("missing_manifest"))).otherwise(none)).when(~F.coalesce("readable", F.lit(True)), F.array(F.lit("manifest_schema"))).otherwise(differs)
    out = runs.withColumn("mismatches", mismatches)
    wrong = F.size("mismatches") > 0
    action = (
        F.when(wrong & ~force, "refused").when(absent & wrong, "force_resume_rebuilt_missing_manifest").when(absent, "created_fresh_manifest")
        .when(wrong, "force_resume_overrode_identity_mismatch").otherwise("validated_existing_manifest")
    )
    return out.select("subset", action.alias("action"), F.array_join("mismatches", ",").alias("mismatches"))


def first_of_group(jobs: DataFrame, group: list[str], order: str, taken: str) -> DataFrame:
    """jobs with producer, the value of taken of the first job by order in its group, and reused, whether that is another job. A job
    with a NULL among its group's columns is in no group."""
    apart = reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in group])
    w = Window.partitionBy(*group, F.when(~apart, F.col(order))).orderBy(order)  # jobs outside of any group spread
    first = F.first(taken).over(w)
    return jobs.withColumns({"producer": F.when(apart, first).otherwise(F.col(taken)), "reused": apart & (F.row_number().over(w) > 1)})
