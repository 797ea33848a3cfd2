"""Records of a run: diagnostics with their reasons, work that is still missing, and closing records of failed tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses that close a task for good, and the endings of diagnostic keys.
CLOSING = ["timeout_retry_exhausted", "empty_retry_exhausted"]
USED, FALLBACK, PLAIN = "_fallback_used", "_fallback_reason", "_reason"


def with_reasons(diagnostics: Column) -> Column:
    """The map with a reason under _fallback_reason for each fallback that was used: its own, or that under _reason where its own is
    blank or missing. A NULL map is an empty one; without any reason nothing is added."""
    given = F.coalesce(diagnostics, F.create_map().cast("map<string,string>"))
    said = lambda k: F.trim(F.coalesce(F.try_element_at(given, k), F.lit("")))
    stem = lambda k, ending: F.left(k, F.length(k) - len(ending))
    used = lambda s: F.coalesce(F.lower(F.try_element_at(given, F.concat(s, F.lit(USED)))) == "true", F.lit(False))
    plain = lambda s: said(F.concat(s, F.lit(PLAIN)))

    def own(k: Column, v: Column) -> Column:
        s = stem(k, FALLBACK)
        blank = k.endswith(FALLBACK) & (F.trim(F.coalesce(v, F.lit(""))) == "")
        return F.when(blank & used(s) & (plain(s) != ""), plain(s)).otherwise(v)

    # entries are looked up one by one: what a lambda holds is computed anew for each
    stems = F.transform(F.filter(F.map_keys(given), lambda k: k.endswith(USED)), lambda k: stem(k, USED))
    open_ = F.filter(stems, lambda s: used(s) & ~F.map_contains_key(given, F.concat(s, F.lit(FALLBACK))) & (plain(s) != ""))
    return F.map_concat(F.transform_values(given, own), F.map_from_entries(F.transform(open_, lambda s: F.struct(F.concat(s, F.lit(FALLBACK)), plain(s)))))


def still_missing(planned: DataFrame, done: DataFrame, keys: list[str], failed: DataFrame | None = None) -> DataFrame:
    """The planned rows whose keys are neither done nor, where that is given, known to have failed."""
    left = planned.join(done.select(*keys).distinct(), keys, "left_anti")
    return left if failed is None else left.join(failed.select(*keys).distinct(), keys, "left_anti")


def closing_records(statuses: DataFrame) -> DataFrame:
    """statuses(task_id, seq, dispatch_id, status) -> task_id, seq, dispatch_id, vlm_json, terminal_error: an empty result for each task
    that used up its retries, with the reason. The closed dispatch is the task's last."""
    closed = statuses.filter(F.col("status").isin(CLOSING))
    return closed.select("task_id", "seq", "dispatch_id", F.lit("{}").alias("vlm_json"), F.col("status").alias("terminal_error"))
