"""Jobs for models: what is sent, whether it can be used, and scoring by an exchangeable backend."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as C

BASE64 = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"


def window_jobs(windows: DataFrame, repeats: int = 3, sheets: bool = False) -> DataFrame:
    """windows(subset, sample_id, window_id, start_frame, end_incl, frame_ids, pass) -> a job for each repeat, with its facts: the pass
    (coarse where blank), the number of frames and the kind of its images, which names any other pass than coarse."""
    rows = windows.withColumn("pass", F.coalesce(F.nullif(F.trim("pass"), F.lit("")), F.lit("coarse"))).withColumn("repeat_index", F.explode(F.sequence(F.lit(0), F.lit(max(1, repeats) - 1))))
    base = F.col("pass") == "coarse"
    kind = F.concat(F.when(base, "window").otherwise(F.col("pass")), F.lit("_contact_sheet" if sheets else "_frame"))
    id_ = F.when(base, C.task_id(F.col("subset"), F.col("sample_id"), "w", F.col("window_id"), F.col("repeat_index"))).otherwise(C.task_id(F.col("subset"), F.col("sample_id"), "rw", F.col("window_id"), F.col("repeat_index")))
    return rows.select(id_.alias("task_id"), "subset", "sample_id", F.lit("window_boundary").alias("job_type"), F.col("pass").alias("window_pass"), "window_id", "repeat_index",
        F.lit(max(1, repeats)).alias("window_repeat_count"), F.size("frame_ids").alias("logical_frame_count"), "start_frame", "end_incl", "frame_ids", kind.alias("image_kind"))


def _whole_list(v: Column, path: str) -> Column:
    """Whether there is a list of texts, none of them blank; a missing one is empty."""
    raw = F.try_variant_get(v, path, "variant")
    items = F.try_variant_get(v, path, "array<variant>")
    each = lambda x: (F.schema_of_variant(x) == "STRING") & (F.trim(F.try_variant_get(x, "$", "string")) != "")
    return F.when(raw.isNull(), F.lit(True)).otherwise(F.coalesce(F.forall(items, each), F.lit(False)))


def transport_reason(v: Column) -> Column:
    """ok, or why the images of a job can't be taken: the typed form (image_transport with a mode) and the older ones (image_paths with
    artifact_manifest_path, images) exclude each other, paths and images are lists of texts that aren't blank, and so is task_id."""
    has = {k: F.try_variant_get(v, f"$.{k}", "variant").isNotNull() for k in ("image_transport", "image_paths", "artifact_manifest_path", "images")}
    paths, typed = has["image_paths"] | has["artifact_manifest_path"], has["image_transport"]
    form = F.schema_of_variant(F.try_variant_get(v, "$.image_transport", "variant"))
    mode = F.try_variant_get(v, "$.image_transport.mode", "string")
    task = F.try_variant_get(v, "$.task_id", "variant")
    named = (F.schema_of_variant(task) == "STRING") & (F.trim(F.try_variant_get(v, "$.task_id", "string")) != "")
    return (
        F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "not_an_object")
        .when(typed & (paths | has["images"]), "mixed_transports").when(paths & has["images"], "several_transports")
        .when(~typed & paths & ~has["image_paths"], "paths_missing").when(~typed & ~paths & ~has["images"], "transport_missing")
        .when(typed & ~form.startswith("OBJECT"), "transport_not_an_object").when(typed & ~F.coalesce(mode.isin("shared_fs", "inline"), F.lit(False)), "unknown_mode")
        .when(typed & (mode == "shared_fs") & ~_whole_list(v, "$.image_transport.image_paths"), "blank_entry").when(typed & (mode == "inline") & ~_whole_list(v, "$.image_transport.images"), "blank_entry")
        .when(~typed & paths & ~_whole_list(v, "$.image_paths"), "blank_entry").when(~typed & has["images"] & ~_whole_list(v, "$.images"), "blank_entry")
        .when(~F.coalesce(named, F.lit(False)), "task_id_blank").otherwise("ok")
    )


def image_bytes(text: Column) -> tuple[Column, Column]:
    """(bytes, reason) of an image sent as base64 or as a data URL; the reason is NULL where there are bytes."""
    body = F.when(text.startswith("data:") & text.contains(","), F.substr(text, F.locate(",", text) + 1)).otherwise(text)
    body = F.regexp_replace(body, r"\s", "")
    reason = F.when(text.isNull() | (body == ""), "empty_payload").when(~body.rlike(BASE64), "base64_decode_failed")
    return F.when(reason.isNull(), F.unbase64(body)), reason


def image_issues(images: DataFrame, most: int = 3) -> DataFrame:
    """images(task_id, index, source, reason) -> for each task with a reason: issue_count, the distinct reasons and sources, sorted, and
    a preview of the first issues."""
    bad = images.filter("reason IS NOT NULL")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), ",")
    one = F.struct("index", F.concat(F.lit("index="), F.col("index").cast("string"), F.lit(":reason="), "reason", F.lit(":source="), F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown"))).alias("said"))
    preview = F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(one)), 1, most), lambda x: x["said"]), ", ")
    return bad.groupBy("task_id").agg(F.count("*").alias("issue_count"), listed("reason").alias("reasons"), listed("source").alias("sources"), preview.alias("preview"))


# A backend makes from one batch of jobs (task_id, images) their results (task_id, transitions, instructions).
Backend = Callable[[pd.DataFrame], pd.DataFrame]
RESULT = "task_id string, transitions array<int>, instructions array<string>"


def dummy(jobs: pd.DataFrame) -> pd.DataFrame:
    """The deterministic stand-in: a cut in the middle of more than eight images."""
    many = jobs["images"] > 8
    cuts = [[int(n) // 2] if m else [] for n, m in zip(jobs["images"], many, strict=True)]
    return pd.DataFrame({"task_id": jobs["task_id"], "transitions": cuts, "instructions": [["First step", "Second step"] if m else ["Single step"] for m in many]})


BACKENDS: dict[str, Callable[..., Backend]] = {"dummy": lambda: dummy}


def register(name: str, make: Callable[..., Backend]) -> None:
    """Makes a backend known by a name; make(**options) is called once in each task, so a model is loaded there once."""
    BACKENDS[name] = make


def scored(jobs: DataFrame, backend: str = "dummy", **options) -> DataFrame:
    """jobs(task_id, images) -> task_id, transitions, instructions by a backend, batch by batch; unknown names raise."""
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend}; known are {', '.join(sorted(BACKENDS))}")
    make = BACKENDS[backend]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = make(**options)
        for batch in batches:
            yield infer(batch)

    return jobs.select("task_id", "images").mapInPandas(run, RESULT)
