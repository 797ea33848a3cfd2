"""Recorded results and events: lines in order, lenient JSON, the last line of a key, and checked payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RESULT = "struct<thought:string,transitions:array<int>,instructions:array<string>>"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """path (a file's), line_no from 0, line: the lines of text files in order, without blank ones, which are counted.

    Files are read by Spark's own splits, so a long file is no single row. A line's number is its rank within its split and the
    lines of the splits before it; the table of splits has one row for each of them.
    """
    at = F.col("_metadata.file_block_start")
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), at.alias("at"), F.monotonically_increasing_id().alias("turn"), F.col("value").alias("line"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("path", "at").orderBy("turn")) - 1)
    sizes = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("path"), at.alias("at")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("path", "at", F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    return rows.join(starts, ["path", "at"]).select("path", (F.col("before") + F.col("rank")).alias("line_no"), "line").filter("trim(line) <> ''")


def whole(v: Column, path: str) -> Column:
    """A whole number at a path of a variant, from numbers, booleans and digits in strings; NULL for anything else."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    text = F.trim(F.try_variant_get(v, path, "string"))
    return F.when(kind == "STRING", F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))).when(kind == "BOOLEAN", F.try_variant_get(v, path, "boolean").cast("int")).otherwise(F.try_variant_get(v, path, "double").try_cast("int"))


def json_in(text: Column) -> Column:
    """The JSON of a model's answer: without code fences, else from the first brace to the last; NULL if neither parses."""
    clean = F.trim(F.replace(F.replace(text, F.lit("```json")), F.lit("```")))
    return F.coalesce(F.try_parse_json(clean), F.try_parse_json(F.nullif(F.regexp_extract(clean, r"(?s)\{.*\}", 0), F.lit(""))))


def checked(v: Column, last: Column | int | None = None, allowed: Column | None = None) -> Column:
    """A model's result as a struct, NULL if it can't be used: one instruction more than transitions, none blank, transitions whole,
    positive, ascending, at most last and among allowed. One string stands for a list of one; a missing thought is empty."""
    texts = F.try_variant_get(v, "$.instructions", "array<variant>")
    one = F.schema_of_variant(F.try_variant_get(v, "$.instructions", "variant")) == "STRING"
    is_text = F.forall(texts, lambda x: F.schema_of_variant(x) == "STRING")
    said = F.transform(F.when(one, F.array(F.try_variant_get(v, "$.instructions", "string"))).when(is_text, F.transform(texts, lambda x: F.try_variant_get(x, "$", "string"))), lambda s: F.trim(s))
    raw = F.try_variant_get(v, "$.transitions", "variant")
    absent = raw.isNull() | (F.schema_of_variant(raw) == "VOID")
    cuts = F.when(absent, F.array().cast("array<int>")).otherwise(F.transform(F.try_variant_get(v, "$.transitions", "array<variant>"), lambda x: whole(x, "$")))
    ok = F.forall(cuts, lambda c: F.coalesce(c > 0, F.lit(False))) & (cuts == F.array_sort(F.array_distinct(cuts)))
    if last is not None:
        ok = ok & F.forall(cuts, lambda c: c <= last)
    if allowed is not None:
        ok = ok & F.forall(cuts, lambda c: F.array_contains(allowed, c))
    ok = ok & F.forall(said, lambda s: s != "") & (F.size(said) == F.size(cuts) + 1)
    thought = F.coalesce(F.try_variant_get(v, "$.thought", "string"), F.lit(""))
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(thought.alias("thought"), cuts.alias("transitions"), said.alias("instructions")).cast(RESULT))


def window_results(log: DataFrame, frames: int) -> DataFrame:
    """log(sample_id, line_no, line) -> sample_id, window_id, repeat_index, error, result: the last line of each window and repeat.

    Lines that are no JSON or lack a whole window id are skipped; a missing repeat is 0. error is the recorded one, or
    invalid_vlm_json where the result can't be used, else NULL.
    """
    v = F.try_parse_json("line")
    repeat = F.try_variant_get("v", "$.repeat_index", "variant")
    kept = log.withColumn("v", v).filter("v IS NOT NULL").withColumn("window_id", whole(F.col("v"), "$.window_id"))
    kept = kept.withColumn("repeat_index", F.when(repeat.isNull() | F.schema_of_variant(repeat).isin("VOID"), 0).otherwise(whole(F.col("v"), "$.repeat_index"))).filter("window_id IS NOT NULL AND repeat_index IS NOT NULL")
    last = kept.groupBy("sample_id", "window_id", "repeat_index").agg(F.max_by("line", "line_no").alias("line"))
    rows = last.withColumn("v", F.try_parse_json("line"))
    rows = rows.withColumn("error", F.nullif(F.trim(F.coalesce(F.try_variant_get("v", "$.terminal_error", "string"), F.lit(""))), F.lit("")))
    rows = rows.withColumn("result", F.when(F.col("error").isNull(), checked(F.try_variant_get("v", "$.vlm_json", "variant"), frames - 1)))
    return rows.select("sample_id", "window_id", "repeat_index", F.when(F.col("result").isNull(), F.coalesce("error", F.lit("invalid_vlm_json"))).alias("error"), "result")


def indexed_results(log: DataFrame, key: str) -> DataFrame:
    """log(sample_id, line_no, line) -> sample_id, key, line, error: the last line of each whole key, and its recorded error or NULL.
    Lines that are no JSON or lack the key are skipped."""
    rows = log.withColumn("v", F.try_parse_json("line")).filter("v IS NOT NULL").withColumn(key, whole(F.col("v"), f"$.{key}")).filter(F.col(key).isNotNull())
    last = rows.groupBy("sample_id", key).agg(F.max_by("line", "line_no").alias("line"))
    error = F.try_variant_get(F.try_parse_json("line"), "$.terminal_error", "string")
    return last.select("sample_id", key, "line", F.nullif(F.trim(F.coalesce(error, F.lit(""))), F.lit("")).alias("error"))


def _with_result(rows: DataFrame, key: str, result: Column) -> DataFrame:
    """rows of indexed_results() with the result of those without an error; an unusable one is invalid_vlm_json."""
    rows = rows.withColumn("v", F.try_parse_json("line")).withColumn("result", F.when(F.col("error").isNull(), result))
    return rows.select("sample_id", key, F.when(F.col("result").isNull(), F.coalesce("error", F.lit("invalid_vlm_json"))).alias("error"), "result")


def segment_labels(log: DataFrame) -> DataFrame:
    """sample_id, segment_id, error, result: the last label of each segment."""
    return _with_result(indexed_results(log, "segment_id"), "segment_id", checked(F.try_variant_get("v", "$.vlm_json", "variant")))


def frame_count(v: Column, at: str = "$") -> Column:
    """The frames of a record: the stated number if it is above 0, else that of its frame ids; NULL if neither is there."""
    stated, ids = whole(v, f"{at}.logical_frame_count"), F.size(F.try_variant_get(v, f"{at}.frame_ids", "array<variant>"))
    return F.coalesce(F.when(stated > 0, stated), F.when(ids > 0, ids))


def refinement_frames(v: Column) -> Column:
    """The frames of a boundary refinement: of its frame ids first, then as frame_count of the record, then of its meta."""
    ids = F.size(F.try_variant_get(v, "$.frame_ids", "array<variant>"))
    return F.coalesce(F.when(ids > 0, ids), frame_count(v), frame_count(v, "$.meta"))


def checked_within(v: Column, frames: Column, allowed: Column | None = None) -> Column:
    """A result checked against its own number of frames, and against allowed positions where those are given; an unknown number
    checks neither."""
    return F.when(frames.isNull(), checked(v)).otherwise(checked(v, frames - 1, allowed))


def boundary_refinements(log: DataFrame, allowed) -> DataFrame:
    """sample_id, boundary_id, error, result: the last refinement of each boundary; allowed gives the positions of a number of frames."""
    v, frames = F.col("v"), refinement_frames(F.col("v"))
    return _with_result(indexed_results(log, "boundary_id"), "boundary_id", checked_within(F.try_variant_get(v, "$.vlm_json", "variant"), frames, allowed(frames.cast("long"))))


def event_records(log: DataFrame) -> DataFrame:
    """The lines of an event log that are JSON objects, parsed as v, with their numbers."""
    return log.withColumn("v", F.try_parse_json("line")).filter("v IS NOT NULL").filter(F.schema_of_variant("v").startswith("OBJECT")).drop("line")


def runtime_objects(files: DataFrame) -> DataFrame:
    """files(sample_id, body) -> sample_id, v: the runtime record of each sample, NULL where its file is no JSON."""
    return files.select("sample_id", F.try_parse_json("body").alias("v"))


# The fields that each manifest must have, with the JSON types that they take.
MANIFEST = {"run_id": "STRING", "subset": "STRING", "data_root": "STRING", "run_dir": "STRING", "config_hash": "STRING", "prompt_hash": "STRING",
            "git_version": "OBJECT", "backend_summary": "OBJECT", "required_stages": "ARRAY<STRING>"}


def manifest_problems(v: Column) -> Column:
    """Sorted names of a manifest's fields that are missing or of another type; all of them where v is no object. No problem is an
    empty array. A list of no stages is one."""
    fits = {k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")) for k in sorted(MANIFEST)}
    good = {k: s.startswith(MANIFEST[k]) if MANIFEST[k] == "OBJECT" else s.isin(MANIFEST[k], "ARRAY<VOID>") if k == "required_stages" else s == MANIFEST[k] for k, s in fits.items()}
    return F.array_compact(F.array(*[F.when(~F.coalesce(g, F.lit(False)), F.lit(k)) for k, g in good.items()]))


def repeat_rollup(results: DataFrame) -> DataFrame:
    """For each window: the successful repeats, the one that stands for them (most transitions, then the first), the failed repeats
    and the first failure's error. A window may have both."""
    ok, bad = F.col("error").isNull(), F.col("error").isNotNull()
    chosen = F.min(F.when(ok, F.struct((-F.size("result.transitions")).alias("n"), "repeat_index", "result")))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.col("repeat_index")))), lambda x: x.cast("string")), " ")
    out = results.groupBy("sample_id", "window_id").agg(F.count_if(ok).alias("successes"), chosen.alias("c"), listed(ok).alias("repeats"), listed(bad).alias("failed"), F.min_by("error", F.when(bad, F.col("repeat_index"))).alias("first_error"))
    return out.select("sample_id", "window_id", "successes", F.col("c.repeat_index").alias("chosen_repeat"), F.col("c.result").alias("result"), "repeats", "failed", "first_error")
