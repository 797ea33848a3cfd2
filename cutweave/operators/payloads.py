"""Models' answers: what a response holds, streamed answers put together, and the checks of summaries and subtitles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.logs import json_in

# Reasons why a response has no payload.
MISMATCH, EMPTY, UNPARSED, MISSING = "body_shape_mismatch", "structured_payload_empty", "parse_failure", "content_missing"
USAGE = ["output_tokens", "completion_tokens", "total_tokens"]


def kind_of(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, ... of a variant; NULL for none."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def text_at(v: Column, path: str) -> Column:
    """The string at a path; NULL if there is something else."""
    return F.when(kind_of(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def items_at(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def output_tokens(v: Column) -> Column:
    """The first usage number that a response states."""
    number = lambda k: F.when(kind_of(F.try_variant_get(v, f"$.usage.{k}", "variant")).isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get(v, f"$.usage.{k}", "double").cast("bigint"))
    return F.coalesce(*[number(k) for k in USAGE])


def response_texts(v: Column) -> Column:
    """Texts of a response in the order in which they are tried: output_text, text, then the contents of its output."""
    inner = F.flatten(F.transform(items_at(v, "$.output"), lambda item: F.transform(items_at(item, "$.content"), lambda c: text_at(c, "$.text"))))
    return F.concat(F.array(text_at(v, "$.output_text"), text_at(v, "$.text")), inner)


def chat_texts(v: Column) -> Column:
    """Texts of a chat completion's choices: a message's content, or the texts of its parts."""
    def of(choice: Column) -> Column:
        parts = F.transform(items_at(choice, "$.message.content"), lambda p: text_at(p, "$.text"))
        return F.concat(F.array(text_at(choice, "$.message.content")), parts)

    return F.flatten(F.transform(items_at(v, "$.choices"), of))


def answers(responses: DataFrame, parsed_path: str, texts) -> DataFrame:
    """responses(id, body) -> id, payload (JSON text), reason: the object that a response states as parsed, else the first text that
    holds JSON. reason is NULL with a payload; a body that is no JSON object doesn't fit."""
    rows = responses.select("id", F.try_parse_json("body").alias("v"))
    given = F.try_variant_get("v", parsed_path, "variant")
    rows = rows.withColumns({"given": F.when(kind_of(given) == "OBJECT", F.to_json(given)), "said": F.filter(texts(F.col("v")), lambda t: F.trim(t) != "")})
    # as text, so that arrays hold nothing but strings
    rows = rows.withColumn("found", F.get(F.filter(F.transform("said", lambda t: F.to_json(json_in(t))), lambda j: j.isNotNull()), F.lit(0)))
    rows = rows.withColumn("chosen", F.coalesce("given", "found"))
    whole = F.col("chosen").startswith("{")
    none = F.when(F.size("said") > 0, UNPARSED).when(F.coalesce(output_tokens(F.col("v")), F.lit(0)) > 0, MISSING).otherwise(MISMATCH)
    reason = F.when(F.coalesce(kind_of(F.col("v")) != "OBJECT", F.lit(True)), MISMATCH).when(F.col("chosen").isNull(), none).when(~whole, MISMATCH).when(F.col("chosen") == "{}", EMPTY)
    return rows.withColumn("reason", reason).select("id", F.when(F.col("reason").isNull(), F.col("chosen")).alias("payload"), "reason")


def streamed(lines: DataFrame) -> DataFrame:
    """lines(id, line_no, line) of event streams -> id, text: the pieces of the data lines before [DONE], in order. Other lines and
    what is no JSON are skipped."""
    data = lines.filter(F.col("line").startswith("data:")).withColumn("data", F.trim(F.substr("line", F.lit(6))))
    data = data.withColumn("over", F.max((F.col("data") == "[DONE]").cast("int")).over(Window.partitionBy("id").orderBy("line_no")))
    piece = F.try_variant_get(F.try_parse_json("data"), "$.choices[0].delta.content", "string")
    pieces = F.array_sort(F.collect_list(F.when((F.col("over") == 0) & piece.isNotNull(), F.struct("line_no", piece.alias("piece")))))
    return data.groupBy("id").agg(F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("text"))


def top_keys(v: Column, most: int = 12) -> Column:
    """The first keys of an object in order; empty for anything else."""
    names = F.array_sort(F.json_object_keys(F.to_json(v)))
    return F.when(kind_of(v) == "OBJECT", F.slice(names, 1, most)).otherwise(F.array().cast("array<string>"))


def finish_reasons(v: Column, most: int = 8) -> Column:
    """The first non-empty finish reasons of a chat completion's choices."""
    told = F.transform(items_at(v, "$.choices"), lambda c: text_at(c, "$.finish_reason"))
    return F.slice(F.filter(told, lambda r: r != ""), 1, most)


def usable_ids(ids: Column) -> Column:
    """Ids of a sample's segments in order; places instead where ids repeat."""
    return F.when(F.size(F.array_distinct(ids)) == F.size(ids), ids).otherwise(F.transform(ids, lambda x, i: i.cast("long")))


def places(ids: Column, c: Column) -> tuple[Column, Column]:
    """The place that a number means among usable_ids() if it is an id first, or a place first; NULL for neither."""
    id_ = F.nullif(F.array_position(ids, c), F.lit(0).cast("long")) - 1
    place = F.when((c >= 0) & (c < F.size(ids).cast("long")), c)
    return F.coalesce(id_, place), F.coalesce(place, id_)


def with_places(tokens: DataFrame, ids: DataFrame, columns: list[str]) -> DataFrame:
    """tokens(sample_id, columns...), ids(sample_id, idx, seg_id) -> tokens with n and, for each column c, c_by_id and c_by_place: the
    place that a number means if it is an id first, or a place first. Ids that repeat in a sample are replaced by places."""
    listed = ids.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("idx", "seg_id")))["seg_id"].alias("ids"))
    rows = tokens.join(listed.select("sample_id", usable_ids(F.col("ids")).alias("ids"), F.size("ids").cast("long").alias("n")), "sample_id")
    for c in columns:
        by_id, by_place = places(F.col("ids"), F.col(c))
        rows = rows.withColumns({f"{c}_by_id": by_id, f"{c}_by_place": by_place})
    return rows.drop("ids")


def subtitles_whole(lines: Column, n: Column) -> Column:
    """Whether lines, an array with subtitle, by_id and by_place of each, give each of n segments exactly one that isn't blank."""
    good = F.filter(lines, lambda x: F.trim(F.coalesce(x["subtitle"], F.lit(""))) != "")
    of = lambda way: F.size(F.array_distinct(F.array_compact(F.transform(good, lambda x: x[way]))))
    return (F.size(lines) == n) & ((of("by_id") == n) | (of("by_place") == n))


def level_whole(items: Column, n: Column, way: str) -> Column:
    """Whether the items of one level, an array in order, are ranges with summaries that follow each other from the first to the last
    of n segments; way, by_id or by_place, tells how their numbers are read."""
    expected = lambda i: F.coalesce(F.when(i > 0, F.get(items, i - 1)[f"end_{way}"] + 1), F.lit(0).cast("long"))
    def fits(x: Column, i: Column) -> Column:
        named = x["start_id"].isNotNull() & x["end_id"].isNotNull() & (F.trim(F.coalesce(x["summary"], F.lit(""))) != "")
        return named & F.coalesce((x[f"start_{way}"] == expected(i)) & (x[f"end_{way}"] >= x[f"start_{way}"]), F.lit(False))

    # the last end may be no number only where an item does not fit
    return F.forall(F.transform(items, fits), lambda f: f) & F.coalesce(F.get(items, F.size(items) - 1)[f"end_{way}"] == n - 1, F.lit(False))


def _level_ways(rows: DataFrame) -> DataFrame:
    """rows of with_places() -> sample_id, level, by_id, by_place: the reasons if numbers are read as ids first, or as places first."""
    keys, ways = ["sample_id", "level"], ("by_id", "by_place")
    named = lambda what: F.concat(F.lit("invalid_"), "level", F.lit(f"_{what}"))
    w = Window.partitionBy(*keys).orderBy("ord")
    rows = rows.select("*", *[F.coalesce(F.lag(f"end_id_{way}").over(w) + 1, F.lit(0).cast("long")).alias(f"expected_{way}") for way in ways])
    found = []
    for way in ways:
        start, end = F.col(f"start_id_{way}"), F.col(f"end_id_{way}")
        fits = (start == F.col(f"expected_{way}")) & (end >= start)
        bad = F.when(F.col("start_id").isNull() | F.col("end_id").isNull(), named("ranges")).when(F.trim(F.coalesce("summary", F.lit(""))) == "", named("summary")).when(~F.coalesce(fits, F.lit(False)), named("partition"))
        found += [F.min(F.when(bad.isNotNull(), F.struct("ord", bad.alias("bad"))))["bad"].alias(f"bad_{way}"), F.max(F.struct("ord", end.alias("end")))["end"].alias(f"last_{way}")]
    reason = lambda way: F.when(F.col(f"bad_{way}").isNotNull(), F.col(f"bad_{way}")).when(F.col(f"last_{way}") != F.col("n") - 1, F.concat(F.lit("incomplete_"), "level", F.lit("_partition"))).otherwise("ok").alias(way)
    return rows.groupBy(*keys, "n").agg(*found).select(*keys, *[reason(way) for way in ways])


def level_reasons(items: DataFrame, ids: DataFrame) -> DataFrame:
    """items(sample_id, level, ord, start_id, end_id, summary) -> sample_id, level, reason of each level that has items.

    Ranges must be numbers, follow each other from the first segment to the last, and have a summary; the first that fails decides.
    Numbers are ids first; if that fails they may be places first. A level is named in its reasons.
    """
    return _level_ways(with_places(items, ids, ["start_id", "end_id"])).select("sample_id", "level", F.when(F.col("by_place") == "ok", "ok").otherwise(F.col("by_id")).alias("reason"))


def subtitle_reasons(items: DataFrame, ids: DataFrame) -> DataFrame:
    """items(sample_id, token, subtitle) -> sample_id, reason: ok if each segment has exactly one subtitle that isn't blank, by ids
    or else by places; invalid_subtitles otherwise, for samples without items too."""
    rows = with_places(items, ids, ["token"])
    good = F.trim(F.coalesce("subtitle", F.lit(""))) != ""
    ways = [F.count_distinct(F.when(good, F.col(f"token_{way}"))).alias(way) for way in ("by_id", "by_place")]
    of = rows.groupBy("sample_id", "n").agg(F.count("*").alias("items"), *ways)
    ok = of.filter((F.col("items") == F.col("n")) & (F.greatest("by_id", "by_place") == F.col("n"))).select("sample_id", F.lit("ok").alias("reason"))
    return ids.select("sample_id").distinct().join(ok, "sample_id", "left").select("sample_id", F.coalesce("reason", F.lit("invalid_subtitles")).alias("reason"))


def summaries_or_identity(items: DataFrame, ids: DataFrame, nested: DataFrame) -> DataFrame:
    """sample_id, level, start_idx, end_idx, applied: the ranges of samples whose levels are all ok and that nested(sample_id) doesn't
    name as crossing; one range for each segment in the levels of all others. The levels are those of items."""
    rows = with_places(items, ids, ["start_id", "end_id"])
    ways = _level_ways(rows)
    # one row for each sample, so that joins need the sample alone, by which rows are dealt
    fine = ways.groupBy("sample_id").agg(F.every((F.col("by_id") == "ok") | (F.col("by_place") == "ok")).alias("ok"), F.collect_set(F.when(F.col("by_id") == "ok", F.col("level"))).alias("by_ids"))
    fine = fine.filter("ok").select("sample_id", "by_ids").join(nested.select("sample_id").distinct(), "sample_id", "left_anti")
    kept = rows.join(fine, "sample_id")
    read = lambda c: F.when(F.array_contains("by_ids", F.col("level")), F.col(f"{c}_by_id")).otherwise(F.col(f"{c}_by_place"))
    kept = kept.select("sample_id", "level", read("start_id").alias("start_idx"), read("end_id").alias("end_idx"), F.lit(True).alias("applied"))
    levels = items.select("level").distinct()
    own = ids.join(fine.select("sample_id"), "sample_id", "left_anti").join(levels)  # the planner knows their size
    return kept.unionByName(own.select("sample_id", "level", F.col("idx").alias("start_idx"), F.col("idx").alias("end_idx"), F.lit(False).alias("applied")))


def fallback_overview(diagnostics: Column) -> Column:
    """struct(applied, fields, reasons) of a map: keys that end in _fallback_used and are true, and their reasons, distinct and sorted.
    A reason stands under _fallback_reason, or under _reason where that is blank."""
    used = F.array_sort(F.map_keys(F.map_filter(diagnostics, lambda k, v: k.endswith("_fallback_used") & (F.lower(v) == "true"))))
    stem = lambda k: F.substring_index(k, "_fallback_used", 1)
    at = lambda k: F.nullif(F.trim(F.coalesce(F.try_element_at(diagnostics, k), F.lit(""))), F.lit(""))
    reasons = F.transform(used, lambda k: F.coalesce(at(F.concat(stem(k), F.lit("_fallback_reason"))), at(F.concat(stem(k), F.lit("_reason")))))
    return F.struct((F.size(used) > 0).alias("applied"), used.alias("fields"), F.array_sort(F.array_distinct(F.array_compact(reasons))).alias("reasons"))


def caption_place(position: Column, x: int, y: int) -> Column:
    """struct(x, y) of a caption as expressions; NULL for an unknown corner."""
    p = F.lower(F.trim(position))
    return F.when(p.isin("top_left", "top_right", "bottom_left", "bottom_right"), F.struct(F.when(p.endswith("right"), f"w-tw-{x}").otherwise(str(x)).alias("x"), F.when(p.startswith("bottom"), f"h-th-{y}").otherwise(str(y)).alias("y")))


def render_facts(v: Column, flags: list[str], counts: list[str]) -> Column:
    """Sorted problems of a render's facts: missing ones, flags that are no booleans, counts that are no whole numbers of at least 0."""
    def problem(key: str, fits: Column) -> Column:
        return F.when(F.try_variant_get(v, f"$.{key}", "variant").isNull(), f"missing_render_fact:{key}").when(~F.coalesce(fits, F.lit(False)), f"invalid_render_fact:{key}")

    kind = lambda k: kind_of(F.try_variant_get(v, f"$.{k}", "variant"))
    all_ = [problem(k, kind(k) == "BOOLEAN") for k in flags] + [problem(k, (kind(k) == "BIGINT") & (F.try_variant_get(v, f"$.{k}", "bigint") >= 0)) for k in counts]
    return F.array_sort(F.array_compact(F.array(*all_)))
