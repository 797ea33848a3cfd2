"""Passes over recorded model answers: merging of segments by attempts, subtitles, and their write-back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import merged_meta
from ..sources.scratch import settled
from . import hierarchy as H
from . import payloads as A
from . import segments as S
from . import wording as D

UNKNOWN = "Unknown task step"


def merge_gate(n: Column, least: int = 12, most: int = 256, enabled: bool = True) -> Column:
    """Why a sample of n segments is not sent to the merge; NULL if it is."""
    if not enabled:
        return F.lit("disabled")
    return F.when(n == 0, "empty_input").when(n < least, "below_min_input_segments").when(n > most, "above_max_input_segments")


def _kept_within(segs: Column, n: Column, ranges: Column, coarse: bool, limit: int, spacing: int, side: int, score: float, tail_frames: int) -> Column:
    """guarded() of one answer: segs and n of D.listed(), ranges an array with start_id and end_id."""
    whole = F.filter(ranges, lambda r: r["start_id"] <= r["end_id"])
    if coarse:
        return F.flatten(F.transform(whole, lambda r: D.anchors(segs, r["start_id"], r["end_id"], limit, spacing, side, score)))
    held = F.transform(F.filter(segs, lambda x: x["held"].isNotNull()), lambda x: x["seg_id"])
    anchors = F.filter(held, lambda b: F.exists(whole, lambda r: (b >= r["start_id"]) & (b < r["end_id"])))
    told = F.array_sort(F.array_union(anchors, F.transform(whole, lambda r: r["end_id"])))
    ends = F.concat(F.filter(told, lambda b: (b >= 0) & (b < n - 1)), F.array(n - 1))
    repeats = F.transform(F.filter(segs, lambda x: x["turn"] & x["again"] & (x["end_excl"] - x["start_frame"] >= tail_frames)), lambda x: x["seg_id"])
    start = lambda all_, i: F.when(i > 0, F.get(all_, i - 1) + 1).otherwise(F.lit(0).cast("long"))
    tails = F.transform(F.array(ends), lambda all_: F.transform(all_, lambda e, i: F.when((e > start(all_, i)) & F.array_contains(repeats, e), e - 1)))
    return F.array_union(anchors, F.array_compact(F.get(tails, F.lit(0))))


def guarded(segments: DataFrame, ranges: DataFrame, coarse: bool = True, support: float = 0.9, limit: int = 1, spacing: int = 3, side: int = 2, score: float = 1.03, tail_frames: int = 5) -> DataFrame:
    """ranges(sample_id, attempt, start_idx, end_idx), partitions of a sample's segments -> sample_id, attempt, boundary: what has to
    stay a boundary inside of them.

    Coarse: the anchors of each range (spaced_anchors). Else each boundary that has a reason to be kept, and then the one before
    a last segment that repeats the text before it (duplicate_tails).
    """
    told = F.struct(F.col("start_idx").cast("long").alias("start_id"), F.col("end_idx").cast("long").alias("end_id"))
    rows = ranges.groupBy("sample_id", "attempt").agg(F.array_sort(F.collect_list(told)).alias("ranges")).join(D.listed(segments, support, not coarse), "sample_id")
    kept = _kept_within(F.col("segs"), F.col("n"), F.col("ranges"), coarse, limit, spacing, side, score, tail_frames)
    return rows.select("sample_id", "attempt", F.explode(kept).alias("boundary"))


def answers_of(attempts: DataFrame, ranges: DataFrame) -> DataFrame:
    """attempts(sample_id, attempt, problem), ranges(sample_id, attempt, ord, start_id, end_id) -> sample_id, answers: a row for each sample
    with its attempts in order, each with its problem and its ranges in order. Both are dealt by sample alone."""
    asked = attempts.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("attempt", F.col("problem").cast("string").alias("problem")))).alias("asked"))
    number = lambda c: F.col(c).cast("long").alias(c)
    given = ranges.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("attempt", "ord", number("start_id"), number("end_id")))).alias("given"))
    own = lambda a: F.transform(F.filter("given", lambda r: r["attempt"] == a["attempt"]), lambda r: F.struct(r["ord"].alias("ord"), r["start_id"].alias("start_id"), r["end_id"].alias("end_id")))
    none = F.array().cast("array<struct<ord:int,start_id:bigint,end_id:bigint>>")
    return asked.join(given, "sample_id", "left").select("sample_id", F.transform("asked", lambda a: F.struct(a["attempt"].alias("attempt"), a["problem"].alias("problem"), F.coalesce(own(a), none).alias("ranges"))).alias("answers"))


def _checked(rows: DataFrame) -> DataFrame:
    """rows(sample_id, n, answers): each answer with its reason, which is the request's problem, or tells whether its ranges are a partition of 0 to n - 1."""
    fields = ("attempt", "problem", "ranges")
    return rows.withColumn("answers", F.transform("answers", lambda a: F.struct(*[a[c].alias(c) for c in fields], F.coalesce(a["problem"], S.partition_reason(a["ranges"], F.col("n"))).alias("reason"))))


def _judged(rows: DataFrame, kept, ratio: float) -> DataFrame:
    """rows of _checked(): each answer with bounds, outputs and guarded, and the reason that it has then. kept(answer) gives the boundaries
    that must stay, which split the ranges of an answer that is a partition; enough ranges have to be left."""
    ok, n = lambda a: a["reason"] == "ok", F.col("n")
    inner = lambda b: F.array_distinct(F.filter(b, lambda x: (x >= 0) & (x < n - 1)))
    own = lambda a: inner(F.transform(a["ranges"], lambda r: r["end_id"]))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("answers", F.transform("answers", lambda a: F.struct(a["attempt"].alias("attempt"), a["reason"].alias("reason"), a["problem"].alias("problem"), F.when(ok(a), own(a)).otherwise(none).alias("own"), F.when(ok(a), inner(F.coalesce(kept(a), none))).otherwise(none).alias("kept"))))
    rows = rows.withColumn("answers", F.transform("answers", lambda a: F.struct(a["attempt"].alias("attempt"), a["reason"].alias("reason"), a["problem"].alias("problem"), F.array_sort(F.array_union(a["own"], a["kept"])).alias("bounds"), (F.size(F.array_except(a["kept"], a["own"])) > 0).alias("guarded"))))
    few = lambda a: ok(a) & (F.size(a["bounds"]) + 1 < S.least_outputs(n, ratio))
    return rows.withColumn("answers", F.transform("answers", lambda a: F.struct(a["attempt"].alias("attempt"), F.when(few(a), "collapsed_too_aggressively").otherwise(a["reason"]).alias("reason"), a["bounds"].alias("bounds"), F.when(a["problem"].isNull(), F.size(a["bounds"]) + 1).cast("long").alias("outputs"), a["guarded"].alias("guarded"))))


def _merged(rows: DataFrame, threshold: float, ratio: float, least: int, most: int) -> DataFrame:
    """rows of _judged(): with valid, mode, outputs and reason as merge_pass() tells them, and ends, the boundaries of a sample that is merged; NULL for all others."""
    gate, n = merge_gate(F.col("n"), least, most), F.col("n")
    rows = rows.withColumn("usable", F.filter("answers", lambda a: a["reason"] == "ok")).withColumn("k", F.size("usable"))
    rows = rows.withColumn("agreed", S.agreed_boundaries(F.col("usable"), n, threshold, ratio))
    nearest = F.when((F.col("k") > 1) & F.col("agreed").isNull(), S.chosen_candidate(F.col("usable")))
    rows = rows.withColumn("one", F.when(F.col("k") == 1, F.get("usable", F.lit(0))).otherwise(nearest))
    agreed = F.col("agreed").isNotNull()
    mode = F.when(agreed, "coarse_boundary_consensus").when(F.col("k") == 1, "first_valid_candidate").when(F.col("k") > 1, "coarse_consensus_candidate")
    outputs = F.when(agreed, (F.size("agreed") + 1).cast("long")).otherwise(F.col("one.outputs"))
    rows = rows.withColumns({"mode": mode, "outs": outputs, "guarded": ~agreed & F.col("one.guarded"), "last": F.get("answers", F.size("answers") - 1)["reason"]})
    same = F.col("outs") == n
    reason = F.coalesce(gate, F.when(F.col("mode").isNull(), F.coalesce("last", F.lit("empty_response"))).when(same & F.col("guarded"), "guard_blocked_all_merges").when(same, "no_merges_selected").otherwise("applied"))
    rows = rows.withColumn("reason", reason).withColumn("ends", F.when(F.col("reason") == "applied", F.coalesce("agreed", "one.bounds")))
    return rows.withColumn("valid", F.col("k").cast("long")).withColumn("outputs", F.coalesce("outs", "n"))


def _asked(rows: DataFrame, coarse: bool, least: int, most: int) -> DataFrame:
    """rows(sample_id, n, answers) with the answers that count: none where the gate is shut, the first alone without coarse."""
    none = F.coalesce("answers", F.array().cast(rows.schema["answers"].dataType))
    some = none if coarse else F.slice(none, 1, 1)
    return rows.withColumn("answers", F.when(merge_gate(F.col("n"), least, most).isNull(), some).otherwise(F.slice(some, 1, 0)))


def merge_pass(sizes: DataFrame, attempts: DataFrame, ranges: DataFrame, kept, ratio: float = 0.35, threshold: float = 0.5, coarse: bool = True, least: int = 12, most: int = 256) -> tuple[DataFrame, DataFrame]:
    """(sample_id, n, valid, mode, outputs, reason; sample_id, boundary of the samples that are merged), for every sample of sizes(sample_id, n).

    attempts(sample_id, attempt, problem): problem is the request's own, NULL where an answer came; ranges(sample_id, attempt, ord,
    start_id, end_id) of the answers; kept(sample_id, boundary): boundaries that must stay, or a function that gives these (sample_id,
    attempt, boundary) for the ranges(sample_id, attempt, start_idx, end_idx) of usable answers. An answer must be a partition of 0 to
    n - 1; boundaries that must stay split its ranges (guarded), and then enough ranges have to be left.

    Without coarse the first attempt alone counts. Of several usable attempts their consensus goes first (coarse_boundary_consensus),
    else the attempt nearest to the others (coarse_consensus_candidate); a single one is the first_valid_candidate. Reasons: the gate's;
    that of the last attempt if none is usable, empty_response without attempts; no_merges_selected or, where a boundary had to stay,
    guard_blocked_all_merges if as many segments come out as went in; else applied.
    """
    rows = _checked(_asked(sizes.select("sample_id", "n").join(answers_of(attempts, ranges), "sample_id", "left"), coarse, least, most))
    if callable(kept):
        rows = settled(rows)
        told = rows.select("sample_id", F.explode(F.filter("answers", lambda a: a["reason"] == "ok")).alias("a")).select("sample_id", "a.attempt", F.explode("a.ranges").alias("r"))
        stay = kept(told.select("sample_id", "attempt", F.col("r.start_id").alias("start_idx"), F.col("r.end_id").alias("end_idx")))
    else:
        stay = kept.withColumn("attempt", F.lit(None).cast("int"))
    stay = stay.groupBy("sample_id").agg(F.collect_list(F.struct("attempt", F.col("boundary").cast("long").alias("boundary"))).alias("stay"))
    own = lambda a: F.transform(F.filter("stay", lambda x: x["attempt"].isNull() | (x["attempt"] == a["attempt"])), lambda x: x["boundary"])
    rows = _merged(_judged(rows.join(stay, "sample_id", "left"), own, ratio), threshold, ratio, least, most)
    rows = settled(rows.select("sample_id", "n", "valid", "mode", "outputs", "reason", "ends"))  # both results read it
    return reported(rows), rows.select("sample_id", F.explode("ends").alias("boundary"))


def reported(rows: DataFrame) -> DataFrame:
    return rows.select("sample_id", "n", "valid", "mode", "outputs", "reason")


def merged_samples(rows: DataFrame, ratio: float = 0.35, threshold: float = 0.5, coarse: bool = True, least: int = 12, most: int = 256, limit: int = 1, spacing: int = 3, side: int = 2, score: float = 1.03, tail_frames: int = 5) -> DataFrame:
    """rows(sample_id, n, segs, answers) of D.listed() and answers_of() with valid, mode, outputs and reason, as merge_pass() tells them,
    and ends, the boundaries of a sample that is merged, else NULL. What has to stay a boundary follows from the segments themselves (guarded).
    All is told by a sample's own row, so rows stay where they are dealt."""
    kept = lambda a: _kept_within(F.col("segs"), F.col("n"), a["ranges"], coarse, limit, spacing, side, score, tail_frames)
    return _merged(_judged(_checked(_asked(rows, coarse, least, most)), kept, ratio), threshold, ratio, least, most)


def joined_segments(rows: DataFrame) -> Column:
    """The segments, in order, of rows of merged_samples(): where ends are told, those of a range are joined and take the best text of those
    they overlap; others keep their segments."""
    fields = [f"{c.name}:{c.dataType.simpleString()}" for c in rows.schema["segs"].dataType.elementType.fields if c.name in COLUMNS]
    text = lambda start, end, own, specific: D.text_among(F.col("segs"), start, end, own, specific)
    own = F.transform("segs", lambda x: F.struct(*[x[c].alias(c) for c in COLUMNS]))
    kind = "array<struct<" + ",".join(sorted(fields, key=lambda f: COLUMNS.index(f.split(":")[0]))) + ">>"
    return F.when(F.col("ends").isNotNull(), S.joined(F.col("segs"), F.concat("ends", F.array(F.col("n") - 1)), text).cast(kind)).otherwise(own.cast(kind))


COLUMNS = ["seg_id", "start_frame", "end_excl", "instruction", "confidence", "support_before", "support_after"]


def requested(answers: DataFrame, most: int = 3) -> DataFrame:
    """answers(sample_id, repeat, attempt from 1, payload, exception, message, adapter) -> sample_id, repeat, payload, reason, error,
    attempts: structured requests over recorded answers.

    The first attempt, of the first most, with a payload that is an object with fields ends a request: reason ok. If none has, reason and
    error are the last one's: the adapter's final_failure_reason, else request_failed: and the exception's name, or empty_response
    where none was raised; the error of the adapter's endpoints, else the exception's message or name. Answers after the end, or
    beyond most, do not count.
    """
    adapter, payload = F.try_parse_json("adapter"), F.try_parse_json("payload")
    said = lambda path: F.nullif(F.trim(F.coalesce(F.try_variant_get(adapter, path, "string"), F.lit(""))), F.lit(""))
    raised = F.col("exception").isNotNull()
    full = ~raised & (F.size(F.map_keys(F.try_variant_get(payload, "$", "map<string,variant>"))) > 0)
    plain = F.when(raised, F.concat(F.lit("request_failed:"), "exception")).otherwise("empty_response")
    told = F.coalesce(*[said(f"$.{end}.{what}") for end in ("chat_completions", "responses") for what in ("error", "exception_type")])
    own = F.when(raised, F.coalesce(told, F.nullif(F.trim("message"), F.lit("")), "exception")).otherwise(F.coalesce(told, F.lit("")))
    rows = answers.filter(F.col("attempt").between(1, max(1, most))).withColumns({"full": F.coalesce(full, F.lit(False)), "reason": F.coalesce(said("$.final_failure_reason"), plain), "error": own})
    one = F.struct("attempt", "payload", "reason", "error")
    of = rows.groupBy("sample_id", "repeat").agg(F.min_by(one, F.when(F.col("full"), F.col("attempt"))).alias("good"), F.max_by(one, "attempt").alias("last"))
    good = F.col("good").isNotNull()
    at = lambda c, other: F.when(good, other).otherwise(F.col(f"last.{c}"))
    return of.select("sample_id", "repeat", F.col("good.payload").alias("payload"), at("reason", F.lit("ok")).alias("reason"), at("error", F.lit("")).alias("error"), F.coalesce("good.attempt", "last.attempt").alias("attempts"))


def merged_segments(segments: DataFrame, attempts: DataFrame, ranges: DataFrame, ratio: float = 0.35, threshold: float = 0.5, coarse: bool = True, least: int = 12, most: int = 256, support: float = 0.9, **guards) -> tuple[DataFrame, DataFrame]:
    """(segments after the merge, report of merge_pass): the pass from end to end. What has to stay a boundary follows from the
    segments themselves (guarded, with its settings); the chosen ranges are applied, and the joined segments take the best text of
    those they overlap. Samples that are not merged keep their segments."""
    rows = D.listed(segments, support, not coarse).join(answers_of(attempts, ranges), "sample_id", "left")
    rows = merged_samples(rows, ratio, threshold, coarse, least, most, **guards)
    rows = settled(rows.select("sample_id", "n", "valid", "mode", "outputs", "reason", joined_segments(rows).alias("all")))  # both results read it
    return rows.select("sample_id", F.inline("all")), reported(rows)


def source_text(instruction: Column) -> Column:
    """The subtitle that a text gives by itself."""
    return F.coalesce(F.nullif(F.trim(instruction), F.lit("")), F.lit(UNKNOWN))


def _subtitle_reason(language: Column, problem: Column, check: Column) -> Column:
    return (
        F.when(language == "en", "source_instruction_reused").when(language != "zh", "unsupported_language")
        .when(problem.isNotNull(), problem).when(check == "ok", "applied").otherwise(F.coalesce(check, F.lit("empty_response")))
    )


def _line(reason: Column, subtitle: Column, instruction: Column) -> dict[str, Column]:
    applied = reason == "applied"
    text = F.when(applied, F.coalesce(F.nullif(F.trim(subtitle), F.lit("")), F.lit(UNKNOWN))).otherwise(source_text(instruction))
    return {"subtitle": text, "language": F.when(applied, "zh").otherwise("en"), "reason": reason, "fallback": ~applied & (reason != "source_instruction_reused")}


def subtitle_pass(segments: DataFrame, requested: DataFrame, items: DataFrame, checks: DataFrame) -> DataFrame:
    """segments(sample_id, seg_id, instruction), requested(sample_id, language, problem), items(sample_id, seg_id, subtitle) by place and
    checks(sample_id, reason) of subtitle_reasons -> sample_id, seg_id, subtitle, language, reason, fallback.

    English takes the texts (source_instruction_reused); other languages than Chinese can't be asked for (unsupported_language);
    a failed request gives its problem, an answer that isn't whole its reason. All but English then fall back to the texts.
    """
    of = requested.join(checks.select("sample_id", F.col("reason").alias("check")), "sample_id", "left")
    of = of.select("sample_id", _subtitle_reason(F.col("language"), F.col("problem"), F.col("check")).alias("reason"))
    rows = segments.join(of, "sample_id").join(items, ["sample_id", "seg_id"], "left")
    return rows.select("sample_id", "seg_id", *[c.alias(k) for k, c in _line(F.col("reason"), F.col("subtitle"), F.col("instruction")).items()])


def written_back(diagnostics: Column, *later: Column) -> Column:
    """Maps of diagnostics as one, in which later maps replace what earlier ones say; NULL maps say nothing."""
    given = lambda m: F.coalesce(m, F.create_map().cast("map<string,string>"))
    return reduce(lambda old, new: merged_meta(new, old), [given(m) for m in (diagnostics, *later)])


def enveloped(rows: DataFrame, levels: list[str], told: Column | None = None) -> DataFrame:
    """rows(sample_id, reason, segs, items, language, problem, said), a row for each sample with its segments in order and the answers about
    them as arrays -> the first columns of stage_envelope(), and its other results as arrays: ways, the ranges of all levels, and lines.
    told, levels by default, are the levels that have items in any sample. All is told by a sample's own row, so rows stay where they lie."""
    n, ids = F.size("segs").cast("long"), A.usable_ids(F.transform("segs", lambda x: x["seg_id"]))
    told = F.array(*[F.lit(k) for k in levels]) if told is None else told
    rows = rows.withColumns({"ids": ids, "n": n})

    def placed(x: Column) -> Column:
        (start, start_), (end, end_) = A.places(F.col("ids"), x["start_id"]), A.places(F.col("ids"), x["end_id"])
        return F.struct(*[x[c].alias(c) for c in ("ord", "level", "start_id", "end_id", "summary")], start.alias("start_by_id"), start_.alias("start_by_place"), end.alias("end_by_id"), end_.alias("end_by_place"))

    def line(x: Column) -> Column:
        by_id, by_place = A.places(F.col("ids"), x["token"])
        return F.struct(x["subtitle"].alias("subtitle"), by_id.alias("by_id"), by_place.alias("by_place"))

    rows = rows.withColumns({"items": F.array_sort(F.transform("items", placed)), "said": F.transform("said", line)})
    of = lambda level: F.filter("items", lambda x: x["level"] == level)
    # a level's numbers are ids if they are right as such, else places; NULL where neither is
    way = lambda level: F.transform(F.array(of(level)), lambda a: F.when(A.level_whole(a, F.col("n"), "by_id"), "id").when(A.level_whole(a, F.col("n"), "by_place"), "place"))[0]
    rows = rows.withColumn("read", F.transform(F.array_distinct(F.transform("items", lambda x: x["level"])), lambda k: F.struct(k.alias("level"), way(k).alias("way"))))
    inside = lambda x, outer: F.exists(outer, lambda o: F.coalesce((o["start_by_id"] <= x["start_by_id"]) & (x["end_by_id"] <= o["end_by_id"]), F.lit(False)))
    crosses = lambda outer, inner: F.exists(of(F.lit(inner)), lambda x: ~inside(x, of(F.lit(outer))))
    crossing = reduce(lambda a, b: a | b, map(crosses, levels, levels[1:]), F.lit(False))
    fine = (F.size("read") > 0) & F.forall("read", lambda r: r["way"].isNotNull()) & ~crossing
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    by_place = lambda x: F.exists("read", lambda r: (r["level"] == x["level"]) & (r["way"] == "place"))
    start = lambda x: F.when(by_place(x), x["start_by_place"]).otherwise(x["start_by_id"])
    end = lambda x: F.when(by_place(x), x["end_by_place"]).otherwise(x["end_by_id"])
    named = lambda x: F.get(F.filter("items", lambda y: (y["level"] == x["level"]) & (y["start_by_id"] == start(x))), F.lit(0))["summary"]
    kept = F.transform("items", lambda x: F.struct(x["level"].alias("level"), start(x).alias("start_idx"), end(x).alias("end_idx"), named(x).alias("summary")))
    own = F.flatten(F.transform(told, lambda k: F.transform("segs", lambda x: F.struct(k.alias("level"), x["seg_id"].alias("start_idx"), x["seg_id"].alias("end_idx"), source_text(x["instruction"]).alias("summary")))))
    rows = rows.withColumn("ways", F.when(F.col("fine"), kept).otherwise(own))
    reason = _subtitle_reason(F.col("language"), F.col("problem"), F.when(A.subtitles_whole(F.col("said"), F.col("n")), "ok").otherwise("invalid_subtitles"))
    rows = rows.withColumn("subtitle_reason", reason)
    subtitle = lambda x: F.get(F.filter("said", lambda y: y["by_id"] == x["seg_id"]), F.lit(0))["subtitle"]
    lines = F.transform("segs", lambda x: F.struct(x["seg_id"].alias("seg_id"), *[c.alias(k) for k, c in _line(F.col("subtitle_reason"), subtitle(x), x["instruction"]).items()]))
    found = lambda c: F.exists("segs", lambda x: x["seg_id"] == c)
    roots = F.size(F.array_distinct(F.transform(F.filter("ways", lambda x: (x["level"] == levels[0]) & found(x["start_idx"]) & found(x["end_idx"])), lambda x: x["start_idx"])))
    applied = F.col("subtitle_reason") == "applied"
    return rows.select("sample_id", (F.col("reason") == "applied").alias("merge_applied"), F.col("reason").alias("merge_reason"), F.col("n").alias("segments"), F.col("fine").alias("summary_applied"), roots.alias("roots"), applied.alias("subtitle_applied"),
                       "subtitle_reason", F.when(applied, "zh").otherwise("en").alias("language"), "ways", lines.alias("lines"))


ENVELOPE = ["sample_id", "merge_applied", "merge_reason", "segments", "summary_applied", "roots", "subtitle_applied", "subtitle_reason", "language"]


def stage_envelope(segments: DataFrame, report: DataFrame, items: DataFrame, levels: list[str], asked: DataFrame, subtitles: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sample_id, merge_applied, merge_reason, segments, summary_applied, roots, subtitle_applied, subtitle_reason, language; the
    hierarchies; the subtitles) for each sample: summary and subtitles over the segments as merged_segments() left them, whether or
    not it merged any.

    items(sample_id, level, ord, start_id, end_id, summary) and subtitles(sample_id, token, subtitle) are the recorded answers about
    these segments, asked(sample_id, language, problem) what was asked for. Levels that are wrong, or that cross, give one range for each
    segment, with its text; subtitles that are not whole give the texts. Samples without an answer fall back likewise.
    """
    number = lambda c: F.col(c).cast("long").alias(c)
    item = F.struct(F.col("ord").cast("int").alias("ord"), "level", number("start_id"), number("end_id"), F.col("summary").cast("string").alias("summary"))
    of = {"segs": (segments, F.struct("seg_id", "start_frame", "end_excl", "instruction")), "items": (items, item), "said": (subtitles, F.struct(number("token"), "subtitle"))}
    listed = {k: df.groupBy("sample_id").agg(F.array_sort(F.collect_list(x)).alias(k)) for k, (df, x) in of.items()}
    rows = report.select("sample_id", "reason").join(listed["segs"], "sample_id").join(asked.select("sample_id", "language", F.col("problem").cast("string").alias("problem")), "sample_id")
    for k in ("items", "said"):
        rows = rows.join(listed[k], "sample_id", "left").withColumn(k, F.coalesce(k, F.array().cast(listed[k].schema[k].dataType)))
    rows = rows.crossJoin(F.broadcast(items.agg(F.array_sort(F.collect_set("level")).alias("told"))))
    rows = settled(enveloped(rows, levels, F.col("told")))  # all three results read it
    return rows.select(*ENVELOPE), H.nested(rows.select("sample_id", F.inline("ways")), segments, levels), rows.select("sample_id", F.inline("lines"))
