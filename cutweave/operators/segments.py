"""Segments: from cut points, overlaps and majority texts, ranges of merged segments and partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as I

UNKNOWN = "Unknown task step"


def from_points(points: DataFrame, samples: DataFrame) -> DataFrame:
    """points(sample_id, point, support), samples(sample_id, nframes) -> sample_id, seg_id, start_frame, end_excl, support_before,
    support_after. The video's two ends are points too; a support that is not known is NULL."""
    ends = samples.filter("nframes > 0").select("sample_id", F.explode(F.array(F.lit(0).cast("long"), F.col("nframes"))).alias("point"), F.lit(None).cast("double").alias("support"))
    inside = points.join(samples, "sample_id").filter("point > 0 AND point < nframes").select("sample_id", "point", "support")
    all_points = inside.unionByName(ends).groupBy("sample_id", "point").agg(F.max("support").alias("support"))
    w = Window.partitionBy("sample_id").orderBy("point")
    rows = all_points.withColumn("end_excl", F.lead("point").over(w)).withColumn("support_after", F.lead("support").over(w)).withColumn("seg_id", (F.row_number().over(w) - 1).cast("long")).filter("end_excl IS NOT NULL")
    return rows.select("sample_id", "seg_id", F.col("point").alias("start_frame"), "end_excl", F.col("support").alias("support_before"), "support_after")


def inner_boundaries(segments: DataFrame, least_support: float | None = None) -> DataFrame:
    """sample_id, seg_id, frame, support: ends of all segments but the last; with least_support the strong ones alone."""
    rows = segments.withColumn("__next", F.lead("seg_id").over(Window.partitionBy("sample_id").orderBy("seg_id"))).filter("__next IS NOT NULL").select("sample_id", "seg_id", F.col("end_excl").alias("frame"), F.col("support_after").alias("support"))
    return rows if least_support is None else rows.filter(F.col("support") >= least_support)


def labelled_frames(results: DataFrame) -> DataFrame:
    """results(sample_id, window_id, frame_ids, transitions, instructions) -> sample_id, window_id, frame, ord, instruction.

    Transitions cut the places of the frames into intervals, one for each instruction; blank and unknown ones label nothing.
    """
    places = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), "transitions", F.array(F.size("frame_ids").cast("long")))))
    rows = results.withColumn("places", places).select("sample_id", "window_id", "frame_ids", "places", F.posexplode("instructions").alias("ord", "text"))
    text = F.trim("text")
    lo, hi = F.get("places", F.col("ord")), F.get("places", F.col("ord") + 1)
    rows = rows.filter((text != "") & (F.lower(text) != "unknown") & lo.isNotNull() & hi.isNotNull())
    return rows.select("sample_id", "window_id", "ord", text.alias("instruction"), F.explode(F.slice("frame_ids", (lo + 1).cast("int"), (hi - lo).cast("int"))).alias("frame"))


def majority_texts(segments: DataFrame, timeline: DataFrame) -> DataFrame:
    """timeline(sample_id, frame, ord, instruction) -> sample_id, seg_id, instruction: the most frequent text of the middle three
    fifths of a segment, the first seen of equals; of the whole segment if the middle has none; unknown if that has none either."""
    margin = F.floor((F.col("end_excl") - F.col("start_frame")) * 0.2).cast("long")
    lo = F.col("start_frame") + margin
    s = segments.select("sample_id", "seg_id", "start_frame", "end_excl", lo.alias("lo"), F.greatest(lo + 1, F.col("end_excl") - margin).alias("hi"))
    met = I.holding(timeline.select("sample_id", "frame", "ord", "instruction"), s, ["sample_id"], "frame", "start_frame", "end_excl")
    met = met.withColumn("mid", ((F.col("frame") >= F.col("lo")) & (F.col("frame") < F.col("hi"))).cast("int"))
    n = met.groupBy("sample_id", "seg_id", "instruction").agg(F.sum("mid").alias("mid"), F.count("*").alias("n"), F.min(F.struct("frame", "ord")).alias("first"), F.min(F.when(F.col("mid") == 1, F.struct("frame", "ord"))).alias("mid_first"))
    best = n.groupBy("sample_id", "seg_id").agg(
        F.min(F.when(F.col("mid") > 0, F.struct((-F.col("mid")).alias("n"), F.col("mid_first").alias("at"), "instruction"))).alias("mid"), F.min(F.struct((-F.col("n")).alias("n"), F.col("first").alias("at"), "instruction")).alias("all")
    )
    return segments.select("sample_id", "seg_id").join(best, ["sample_id", "seg_id"], "left").select("sample_id", "seg_id", F.coalesce("mid.instruction", "all.instruction", F.lit(UNKNOWN)).alias("instruction"))


def overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of segments of one sample with frames in common: sample_id, seg_id, other_id, overlap."""
    a = left.select("sample_id", "seg_id", "start_frame", "end_excl")
    b = right.select("sample_id", F.col("seg_id").alias("other_id"), F.col("start_frame").alias("s"), F.col("end_excl").alias("e"))
    met = I.overlapping(a, b, ["sample_id"], ("start_frame", "end_excl", "s", "e"))
    return met.select("sample_id", "seg_id", "other_id", (F.least("end_excl", "e") - F.greatest("start_frame", "s")).alias("overlap"))


def support_between(after: Column, before: Column) -> tuple[Column, Column]:
    """(support of a boundary, whether it is known) from the left segment's after and the right one's before; NULL is not known."""
    zero = F.lit(0.0)
    return F.greatest(zero, F.coalesce(after, zero), F.coalesce(before, zero)), after.isNotNull() | before.isNotNull()


def _ranges(rows: DataFrame, *more: Column) -> DataFrame:
    """rows(sample_id, n, boundary) -> sample_id, start_idx, end_idx: the partition of 0 to n - 1 for each sample that has a row. A boundary begins a range after
    the one before it, the last row of a sample the rest too; repeated boundaries and those outside count as one or none. more columns may be added."""
    w = Window.partitionBy("sample_id").orderBy("b")  # those outside are NULL and come first
    rows = rows.filter("n > 0").select("sample_id", "n", F.when((F.col("boundary") >= 0) & (F.col("boundary") < F.col("n") - 1), F.col("boundary")).alias("b"))
    back = F.lag("b").over(w)
    rows = rows.select("sample_id", "n", "b", *more, back.alias("back"), F.lead("n").over(w).isNull().alias("ends"))
    pair = lambda start, end: F.struct(F.coalesce(start + 1, F.lit(0).cast("long")).alias("start_idx"), end.cast("long").alias("end_idx"))
    own = F.when(F.col("b").isNotNull() & (F.col("back").isNull() | (F.col("back") != F.col("b"))), pair(F.col("back"), F.col("b")))
    rest = F.when(F.col("ends"), pair(F.col("b"), F.col("n") - 1))
    return rows.select("*", F.inline(F.array_compact(F.array(own, rest)))).drop("n", "b", "back", "ends")


def ranges_from_boundaries(bounds: DataFrame, sizes: DataFrame) -> DataFrame:
    """bounds(sample_id, boundary), sizes(sample_id, n) -> sample_id, start_idx, end_idx: the ordered partition of 0 to n - 1."""
    return _ranges(sizes.select("sample_id", "n").join(bounds.select("sample_id", "boundary"), "sample_id", "left"))


def boundaries_of_ranges(ranges: DataFrame) -> DataFrame:
    """Ends of all ranges of a sample but the last."""
    w = Window.partitionBy("sample_id").orderBy("end_idx")
    return ranges.withColumn("__next", F.lead("end_idx").over(w)).filter("__next IS NOT NULL").select("sample_id", F.col("end_idx").alias("boundary"))


def least_outputs(n: Column, ratio: float) -> Column:
    """Fewest ranges that n segments may be merged into."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(n.cast("double") * ratio).cast("long"))


def partition_reasons(ranges: DataFrame, sizes: DataFrame, ratio: float) -> DataFrame:
    """ranges(sample_id, ord, start_id, end_id), sizes(sample_id, n) -> sample_id, reason, ranges.

    Reasons: invalid_merged_ranges without ranges or with one that is no pair of numbers, invalid_partition where a range does not
    begin right after the one before it or leaves 0 to n - 1, incomplete_partition where the last ends early,
    collapsed_too_aggressively with too few of them, else ok. The first range that fails decides.
    """
    w = Window.partitionBy("sample_id").orderBy("ord")
    rows = ranges.join(sizes, "sample_id").withColumn("expected", F.coalesce(F.lag("end_id").over(w) + 1, F.lit(0).cast("long")))
    bad = F.when(F.col("start_id").isNull() | F.col("end_id").isNull(), "invalid_merged_ranges").when(
        F.coalesce((F.col("start_id") != F.col("expected")) | (F.col("end_id") < F.col("start_id")) | (F.col("end_id") >= F.col("n")), F.lit(True)), "invalid_partition")
    of = rows.withColumn("bad", bad).groupBy("sample_id", "n").agg(F.min_by("bad", F.when(F.col("bad").isNotNull(), F.col("ord"))).alias("bad"), F.max_by("end_id", "ord").alias("last"), F.count("*").alias("ranges"))
    reason = F.when(F.col("bad").isNotNull(), F.col("bad")).when(F.col("last") != F.col("n") - 1, "incomplete_partition").when(F.col("ranges") < least_outputs(F.col("n"), ratio), "collapsed_too_aggressively").otherwise("ok")
    checked = of.select("sample_id", reason.alias("reason"), "ranges")
    none = sizes.join(ranges.select("sample_id").distinct(), "sample_id", "left_anti").select("sample_id", F.lit("invalid_merged_ranges").alias("reason"), F.lit(0).cast("long").alias("ranges"))
    return checked.unionByName(none)


def partition_reason(ranges: Column, n: Column) -> Column:
    """partition_reasons() of one answer without a least number of ranges: ranges is an array of ord, start_id, end_id in order."""
    expected = lambda i: F.coalesce(F.when(i > 0, F.get(ranges, i - 1)["end_id"] + 1), F.lit(0).cast("long"))
    wrong = lambda r, i: F.coalesce((r["start_id"] != expected(i)) | (r["end_id"] < r["start_id"]) | (r["end_id"] >= n), F.lit(True))
    bad = F.transform(ranges, lambda r, i: F.when(r["start_id"].isNull() | r["end_id"].isNull(), "invalid_merged_ranges").when(wrong(r, i), "invalid_partition"))
    first = F.get(F.array_compact(bad), F.lit(0))
    return F.when(F.coalesce(F.size(ranges), F.lit(0)) == 0, "invalid_merged_ranges").otherwise(F.coalesce(first, F.when(F.get(ranges, F.size(ranges) - 1)["end_id"] != n - 1, "incomplete_partition"), F.lit("ok")))


def spelled(ranges: DataFrame) -> DataFrame:
    """A row for each segment of each range."""
    some = ranges.filter("start_idx <= end_idx")
    return some.withColumn("seg_id", F.explode(F.sequence("start_idx", "end_idx")))


def merged_by_ranges(segments: DataFrame, ranges: DataFrame) -> DataFrame:
    """segments(..., seg_id from 0), ranges(sample_id, start_idx, end_idx) -> a segment for each range: its ends, the confidence
    weighed by frames, the outer supports, and its longest distinct text, the first of equals; unknown if all are blank."""
    # by sample alone, by which both sides are dealt: with seg_id as a key both would be dealt again, texts and all
    met = segments.join(ranges, "sample_id").filter(F.col("seg_id").between(F.col("start_idx"), F.col("end_idx")))
    frames = F.greatest(F.lit(1).cast("long"), F.col("end_excl") - F.col("start_frame"))
    text = F.trim("instruction")
    named = F.when(text != "", F.struct((-F.length(text)).alias("n"), "seg_id", text.alias("text")))
    out = met.groupBy("sample_id", "start_idx", "end_idx").agg(
        F.min_by("start_frame", "seg_id").alias("start_frame"), F.max_by("end_excl", "seg_id").alias("end_excl"), F.sum(frames).alias("frames"), F.sum(F.col("confidence") * frames).alias("w"),
        F.coalesce(F.min_by("support_before", "seg_id"), F.lit(0.0)).alias("support_before"), F.coalesce(F.max_by("support_after", "seg_id"), F.lit(0.0)).alias("support_after"), F.min(named).alias("named"),
    )
    rank = (F.row_number().over(Window.partitionBy("sample_id").orderBy("start_idx")) - 1).cast("long")
    return out.select("sample_id", rank.alias("seg_id"), "start_frame", "end_excl", F.coalesce("named.text", F.lit(UNKNOWN)).alias("instruction"), (F.col("w") / F.col("frames")).alias("confidence"), "support_before", "support_after")


def _named(bounds: Column, least) -> Column:
    """The boundaries, in order, with as many votes as least(votes) asks for: bounds holds those of all candidates, in an array of one, so that it is made once."""
    return F.get(F.transform(F.array(bounds), lambda all_: F.filter(F.array_sort(F.array_distinct(all_)), lambda b: least(F.size(F.filter(all_, lambda x: x == b))))), F.lit(0))


def agreed_boundaries(candidates: Column, n: Column, threshold: float, ratio: float) -> Column:
    """boundary_consensus() of one sample: candidates is an array with bounds each; NULL where they do not agree."""
    bounds = F.flatten(F.transform(candidates, lambda c: c["bounds"]))
    agreed = F.when(F.size(candidates) > 1, _named(bounds, lambda votes: votes > F.size(candidates) * F.lit(threshold)))
    # in an array of one, so that votes are counted once
    return F.get(F.transform(F.array(agreed), lambda a: F.when((F.size(a) > 0) & (F.size(a) + 1 >= least_outputs(n, ratio)), a)), F.lit(0))


def chosen_candidate(candidates: Column) -> Column:
    """candidate_choice() of one sample: candidates is an array with attempt and the different bounds of each."""
    bounds, half = F.flatten(F.transform(candidates, lambda c: c["bounds"])), F.floor(F.size(candidates) / 2).cast("int")
    shared = _named(bounds, lambda votes: votes >= half + 1)
    median = F.get(F.array_sort(F.transform(candidates, lambda c: F.size(c["bounds"]))), half)
    told = F.transform(F.array(F.struct(shared.alias("shared"), median.alias("median"))), lambda s: F.transform(candidates, lambda c: F.struct(F.size(F.array_intersect(c["bounds"], s["shared"])).alias("supported"), F.size(c["bounds"]).alias("all"), s["median"].alias("median"), c.alias("c"))))
    ratio = lambda x: F.when(x["all"] > 0, x["supported"] / x["all"]).otherwise(1.0)
    key = lambda x: F.struct((-x["supported"]).alias("a"), F.abs(x["all"] - x["median"]).alias("b"), (x["all"] - x["supported"]).alias("c"), (-ratio(x)).alias("d"), x["c"]["attempt"].alias("e"), x["c"].alias("f"))
    # the one with the least key is among those with nearly the most: the first part of the key is what they have
    return F.array_min(F.transform(F.get(told, F.lit(0)), key))["f"]


def joined(segs: Column, ends: Column, text=None) -> Column:
    """merged_by_ranges() of one sample: segs is an array of its segments in order, ends are the last places of the ranges, in order.
    text(start_frame, end_excl, text, specific) may put another text for a joined segment's."""
    parts = F.transform(ends, lambda e, i: F.filter(segs, lambda x: (x["seg_id"] <= e) & (x["seg_id"] > F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(-1).cast("long")))))
    frames = lambda x: F.greatest(F.lit(1).cast("long"), x["end_excl"] - x["start_frame"])
    total = lambda p, of: F.aggregate(p, F.lit(0.0), lambda a, x: a + F.coalesce(of(x), F.lit(0.0)))
    named = lambda p: F.array_min(F.transform(F.filter(p, lambda x: F.trim(x["instruction"]) != ""), lambda x: F.struct((-F.length(F.trim(x["instruction"]))).alias("n"), x["seg_id"].alias("seg_id"), F.trim(x["instruction"]).alias("text"), x["specific"].alias("specific"))))

    def one(p: Column) -> Column:
        first, last = F.get(p, F.lit(0)), F.get(p, F.size(p) - 1)
        known = F.exists(p, lambda x: x["confidence"].isNotNull())
        confidence = F.when(known, total(p, lambda x: x["confidence"] * frames(x)) / total(p, lambda x: frames(x).cast("double")))
        return F.struct(first["start_frame"].alias("start_frame"), last["end_excl"].alias("end_excl"), named(p).alias("named"), confidence.alias("confidence"), F.coalesce(first["support_before"], F.lit(0.0)).alias("support_before"), F.coalesce(last["support_after"], F.lit(0.0)).alias("support_after"))

    # a text that names nothing is no general one, so it is specific
    told = lambda x: (F.coalesce(x["named"]["text"], F.lit(UNKNOWN)), F.coalesce(x["named"]["specific"], F.lit(True)))
    own = lambda x: told(x)[0] if text is None else text(x["start_frame"], x["end_excl"], *told(x))
    whole = F.transform(F.filter(parts, lambda p: F.size(p) > 0), one)
    return F.transform(whole, lambda x, i: F.struct(i.cast("long").alias("seg_id"), x["start_frame"].alias("start_frame"), x["end_excl"].alias("end_excl"), own(x).alias("instruction"), x["confidence"].alias("confidence"), x["support_before"].alias("support_before"), x["support_after"].alias("support_after")))


def boundary_consensus(candidates: DataFrame, sizes: DataFrame, threshold: float, ratio: float) -> DataFrame:
    """candidates(sample_id, candidate, boundary), sizes(sample_id, n, candidates) -> ranges that more than threshold of a sample's
    candidates agree on; none for a sample with one candidate, without such a boundary, or with too few ranges."""
    votes = candidates.groupBy("sample_id", "boundary").agg(F.count("*").alias("votes")).join(sizes, "sample_id")
    agreed = votes.filter((F.col("candidates") > 1) & (F.col("votes") > F.col("candidates") * F.lit(threshold)))
    k = F.count("b").over(Window.partitionBy("sample_id")) + 1
    enough = (k >= least_outputs(F.col("n"), ratio)).alias("enough")
    return _ranges(agreed, enough).filter("enough").select("sample_id", "start_idx", "end_idx")


def candidate_choice(candidates: DataFrame) -> DataFrame:
    """candidates(sample_id, candidate, boundaries array<bigint>) -> sample_id, candidate, supported, unsupported, outputs, quorum of
    the chosen one: of those with nearly the most boundaries that a majority shares, the one with most of them, then nearest to the
    upper median of output counts, then with fewest others, then with the larger shared part, then the first."""
    total = candidates.groupBy("sample_id").agg(F.count("*").alias("total"), F.array_sort(F.collect_list(F.size("boundaries") + 1)).alias("outs"))
    total = total.select("sample_id", (F.floor(F.col("total") / 2) + 1).alias("quorum"), F.get("outs", F.floor(F.col("total") / 2).cast("int")).alias("median"))
    each = candidates.select("sample_id", "candidate", F.explode("boundaries").alias("b"))
    shared = each.groupBy("sample_id", "b").agg(F.count("*").alias("v")).join(total, "sample_id").filter(F.col("v") >= F.col("quorum"))
    n = each.join(shared.select("sample_id", "b"), ["sample_id", "b"]).groupBy("sample_id", "candidate").agg(F.count("*").alias("supported"))
    rows = candidates.join(n, ["sample_id", "candidate"], "left").join(total, "sample_id").withColumn("supported", F.coalesce("supported", F.lit(0).cast("long")))
    rows = rows.withColumn("outputs", (F.size("boundaries") + 1).cast("long")).withColumn("unsupported", F.size("boundaries") - F.col("supported"))
    rows = rows.withColumn("top", F.max("supported").over(Window.partitionBy("sample_id"))).filter(F.col("supported") >= F.col("top") - 1)
    ratio = F.when(F.size("boundaries") > 0, F.col("supported") / F.size("boundaries")).otherwise(1.0)
    key = F.struct((-F.col("supported")).alias("a"), F.abs(F.col("outputs") - F.col("median")).alias("b"), F.col("unsupported").alias("c"), (-ratio).alias("d"), F.col("candidate").alias("e"))
    return rows.groupBy("sample_id").agg(F.min_by(F.struct("candidate", "supported", "unsupported", "outputs", "quorum"), key).alias("x")).select("sample_id", "x.*")


def nesting_violations(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Ranges of inner(sample_id, start_idx, end_idx) that lie in no single range of outer."""
    o = outer.select("sample_id", F.col("start_idx").alias("s"), F.col("end_idx").alias("e"))
    i = inner.alias("i")
    return i.join(o.alias("o"), (F.col("i.sample_id") == F.col("o.sample_id")) & (F.col("o.s") <= F.col("i.start_idx")) & (F.col("i.end_idx") <= F.col("o.e")), "left_anti")
