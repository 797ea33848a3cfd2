"""From window results to segments: cleaning, boundary shifts, guards against over-merging, and the whole assembly.

Each step is a window or an aggregate over a sample's segments; nothing is looped over on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions import text as T
from ..sources.scratch import settled
from . import intervals as I
from . import segments as S
from . import votes as V
from . import wording as D
from .drift import split_on_drift
from .windows import centre_weight

# Words that tell a finished action from its preparation, and how preparations begin.
COMPLETION = ["connect", "fold", "insert", "nest", "place", "plug", "pour", "remove", "retrieve", "stack"]
POSITIONING = ["align", "approach", "hover", "reach"]
GRIPPER_PHRASES = ["align the gripper", "align gripper", "position the gripper", "position gripper", "reposition the gripper"]
FULL_FAMILIES = {**X.FAMILIES, "cook": [*X.FAMILIES["cook"], "bake", "heat", "microwave"], "transfer": [*X.FAMILIES["transfer"], "carry", "insert", "lift", "pick", "put", "stack"]}
SPANS = ["start_frame", "end_excl", "instruction", "confidence", "support_before", "support_after"]


def full_families(all_words: Column) -> Column:
    """Kinds of action that any word of a text names."""
    return F.array_compact(F.array(*[F.when(T.has(all_words, v), F.lit(k)) for k, v in sorted(FULL_FAMILIES.items())]))


def is_bridge(all_words: Column, primary: Column) -> Column:
    """Whether a text tells of the robot's motion alone."""
    return ~T.some(primary) & T.has(all_words, X.ROBOT)


def is_preparation(text: Column, all_words: Column) -> Column:
    low = F.trim(F.lower(text))
    phrases = low.startswith("reach ")
    for p in GRIPPER_PHRASES:
        phrases = phrases | low.contains(p)
    return phrases | (T.has(all_words, ["prepare", *POSITIONING]) & ~T.has(all_words, COMPLETION))


def wants_refinement(text: Column, all_words: Column) -> Column:
    """Whether one text names several steps: two kinds of action besides moving, or one and a general phase, in several clauses."""
    low = F.lower(text)
    kinds = F.size(T.without(full_families(all_words), ["transfer"]))
    clauses = low.contains(" and ") | low.contains(" then ") | low.contains(",")
    return clauses & ((kinds >= 2) | ((kinds >= 1) & T.has(all_words, X.PHASE_NOUN)))


def _with_kinds(segments: DataFrame, texts: DataFrame | None) -> DataFrame:
    d = D.glossary(segments) if texts is None else texts
    d = d.select("instruction", is_bridge(F.col("all_words"), F.col("primary")).alias("bridge"), is_preparation(F.col("instruction"), F.col("all_words")).alias("prep"), "filler", "specific", T.within(F.col("dest"), X.CONTAINER).alias("dishes"), "primary")
    return segments.join(d, "instruction")


KINDS = ["bridge", "prep", "filler", "specific", "dishes", "primary"]


def _joined(rows: DataFrame, group: str, keeps: Column) -> DataFrame:
    """One segment for each group: its whole span, the best confidence, and all else from the row that is kept."""
    kept = F.struct(*[c for c in SPANS if c not in ("start_frame", "end_excl", "confidence")], *KINDS, "seg_id")
    out = rows.groupBy("sample_id", group).agg(F.min("start_frame").alias("start_frame"), F.max("end_excl").alias("end_excl"), F.max("confidence").alias("confidence"), F.max_by(kept, F.struct(keeps.cast("int"), "seg_id")).alias("k"))
    return out.select("sample_id", "start_frame", "end_excl", "confidence", "k.*")


def _absorbed(rows: DataFrame, aside: Column, least_tail_sec: float, fps: float) -> DataFrame:
    """Joins runs of rows that stand aside with the row after them; the last run with the row before it if it lasts longer than
    least_tail_sec, else it goes. Samples where all stand aside stay as they are."""
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    rows = rows.withColumn("aside", aside)
    own = F.when(F.col("aside"), 0).otherwise(1)
    rows = rows.withColumn("group", F.coalesce(F.sum(own).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")).withColumn("total", F.sum(own).over(Window.partitionBy("sample_id")))
    run = Window.partitionBy("sample_id", "group")
    tail = (F.col("group") == F.col("total")) & (F.col("total") > 0)
    seconds = (F.max("end_excl").over(run) - F.min("start_frame").over(run)) / F.lit(fps)
    rows = rows.withColumn("tail_sec", F.when(tail, seconds)).filter(F.col("tail_sec").isNull() | (F.col("tail_sec") > least_tail_sec))
    group = F.when(F.col("total") == 0, F.col("seg_id")).when(F.col("tail_sec").isNotNull(), F.col("group") - 1).otherwise(F.col("group"))
    return _joined(rows.withColumn("group", group), "group", ~F.col("aside"))


def cleaned(segments: DataFrame, fps: float = 30.0, texts: DataFrame | None = None) -> DataFrame:
    """Takes aside what is no task: motions of the robot and short fillers join what follows, longer fillers between two different
    tasks join what they follow, short preparations join what follows or, as a short end, go. texts may be a glossary()."""
    rows = _with_kinds(segments, texts)
    seconds = F.greatest(F.lit(0.0), (F.col("end_excl") - F.col("start_frame")) / fps)
    rows = _absorbed(rows, F.col("bridge") | (F.col("filler") & (seconds <= 5.0)), -1.0, fps)
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    back, ahead = lambda c: F.lag(c).over(w), lambda c: F.lead(c).over(w)
    shift = (F.array_sort(back("dishes")) != F.array_sort(ahead("dishes"))) | (T.similarity(back("primary"), ahead("primary")) < 0.25)
    into = F.coalesce(F.col("filler") & (seconds > 5.0) & (seconds <= 12.0) & back("specific") & ahead("specific") & shift, F.lit(False))
    rows = rows.withColumn("into", into).withColumn("group", F.sum(F.when(F.col("into"), 0).otherwise(1)).over(w))
    rows = _joined(rows, "group", ~F.col("into"))
    rows = _absorbed(rows, F.col("prep") & (seconds <= 5.0), 3.0, fps)
    return rows.select("sample_id", (F.row_number().over(w) - 1).cast("long").alias("seg_id"), *SPANS)


def shifted_boundaries(segments: DataFrame, picked: DataFrame) -> DataFrame:
    """picked(sample_id, seg_id, frame): a new place for the boundary after a segment. Places stay inside the two segments around, and
    each boundary stays after the one before it."""
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    rows = segments.join(picked.select("sample_id", "seg_id", F.col("frame").alias("pick")), ["sample_id", "seg_id"], "left").withColumn("next_end", F.lead("end_excl").over(w))
    own = F.greatest(F.col("start_frame") + 1, F.least("pick", F.col("next_end") - 1))
    fits = (own > F.col("start_frame")) & (own < F.col("next_end"))
    place = F.least(F.when(F.col("pick").isNotNull() & fits, own).otherwise(F.col("end_excl")), F.col("next_end") - 1)
    # place k must lie after place k - 1: the running maximum of what is left without the count of places
    rows = rows.withColumn("k", F.row_number().over(w).cast("long")).withColumn("slack", F.when(F.col("next_end").isNotNull(), place - F.col("k")))
    first = F.first("start_frame").over(w)
    at = F.greatest(F.max("slack").over(w), first) + F.col("k")
    rows = rows.withColumn("end_new", F.when(F.col("next_end").isNotNull(), at).otherwise(F.col("end_excl")))
    return rows.select("sample_id", "seg_id", F.coalesce(F.lag("end_new").over(w), "start_frame").alias("start_frame"), F.col("end_new").alias("end_excl"), "instruction", "confidence", "support_before", "support_after")


def rejected(frame: Column, instructions: Column, support: Column, most_support: float) -> Column:
    """Whether a refinement takes a boundary away: it names no frame, tells one task alone, and the support is at most so large. Negative limits
    take none."""
    told = F.size(F.filter(instructions, lambda t: F.trim(t) != "")) == 1
    return F.coalesce(frame.isNull() & told & (support <= most_support), F.lit(False)) if most_support >= 0 else F.lit(False)


def refined_boundaries(segments: DataFrame, refinements: DataFrame, fps: float = 30.0, most_support: float = -1.0) -> DataFrame:
    """segments with boundaries moved or taken away by refinements(sample_id, seg_id, frame_ids, transitions, instructions) of the
    boundary after seg_id; seg_id counts anew.

    The first transition that lies inside frame_ids names the new frame. A boundary that abstains (rejected()) joins its segments:
    from the left, later_text() names the text, the last known support after stays. All others lie after the one before them and
    before the end of their right segment; where a support is known, both sides get it. Samples without refinements keep their
    boundaries but for that; an empty table gives no rows.
    """
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    rows = segments.select("sample_id", "seg_id", "start_frame", "end_excl", "instruction", "confidence", "support_before", "support_after")
    named = F.filter(F.transform("transitions", lambda t: F.when(t >= 0, F.get("frame_ids", t.cast("int")))), lambda f: f.isNotNull())
    told = refinements.select("sample_id", F.col("seg_id").alias("told_id"), F.get(named, F.lit(0)).cast("long").alias("pick"), F.col("instructions").alias("told"))
    # a segment and its refinement lie in one place of a window by sample: joined by both keys all rows would be dealt again
    both = I.beside(rows, told, ["sample_id"]).withColumn("seg_id", F.coalesce("__a.seg_id", "__b.told_id"))
    both = both.withColumn("t", F.first("__b", True).over(Window.partitionBy("sample_id", "seg_id"))).filter("__a IS NOT NULL")
    rows = both.select("sample_id", *[f"__a.{c}" for c in rows.columns if c != "sample_id"], "t.pick", "t.told")
    support, known = S.support_between(F.col("support_after"), F.lead("support_before").over(w))
    rows = rows.withColumns({"next_end": F.lead("end_excl").over(w), "support": support, "known": known})
    rows = rows.withColumn("gone", F.col("next_end").isNotNull() & rejected(F.col("pick"), F.col("told"), F.col("support"), most_support))
    own = F.greatest(F.col("start_frame") + 1, F.least("pick", F.col("next_end") - 1))
    fits = F.col("pick").isNotNull() & (own > F.col("start_frame")) & (own < F.col("next_end"))
    rows = rows.withColumn("place", F.least(F.when(fits, own).otherwise(F.col("end_excl")), F.col("next_end") - 1))
    rows = rows.withColumn("group", F.coalesce(F.sum(F.when(F.col("gone"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))

    kept = ["instruction", "ingredients", "prep_ingredient", "actions", "specificity"]
    of = D.glossary(segments).select(*kept, F.lit(True).alias("described"))
    item = F.when(F.col("described"), F.struct("seg_id", "start_frame", "end_excl", *kept))
    last = F.max_by(F.struct("end_excl", "next_end", "place", "support", "known"), "seg_id").alias("last")
    groups = rows.join(of, "instruction", "left").groupBy("sample_id", "group").agg(
        F.min_by(F.struct("start_frame", "confidence", "support_before"), "seg_id").alias("first"), last, F.max_by("support_after", F.when(F.col("support_after").isNotNull(), F.col("seg_id"))).alias("after"), F.array_sort(F.collect_list(item)).alias("all")
    )
    g = Window.partitionBy("sample_id").orderBy("group")
    inner = F.col("last.next_end").isNotNull()
    # boundary k lies after boundary k - 1: the running maximum of what is left without the count of boundaries
    slack = F.max(F.when(inner, F.col("last.place") - F.col("group") - 1)).over(g)
    begin = F.first("first.start_frame").over(g)
    groups = groups.withColumn("end_new", F.when(inner, F.greatest(slack, begin) + F.col("group") + 1).otherwise(F.col("last.end_excl")))
    before = F.when(F.lag("last.known").over(g), F.lag("last.support").over(g)).otherwise(F.col("first.support_before"))
    after = F.when(inner & F.col("last.known"), F.col("last.support")).otherwise(F.col("after"))
    out = groups.select(
        "sample_id", F.col("group").alias("seg_id"), F.coalesce(F.lag("end_new").over(g), "first.start_frame").alias("start_frame"), F.col("end_new").alias("end_excl"), "all",
        F.col("first.confidence").alias("confidence"), before.alias("support_before"), after.alias("support_after"),
    )

    # the texts of joined segments, from the left; what is joined so far lasts from its new start to the end of the next segment
    def step(last: Column, x: Column) -> Column:
        frames = {"l_frames": x["end_excl"] - F.col("start_frame"), "r_frames": x["end_excl"] - x["start_frame"]}
        look = lambda name: frames[name] if name in frames else (last if name[:2] == "l_" else x)[name[2:]]
        right = D.later_text(fps, look)
        text = [F.when(right, x[c]).otherwise(last[c]).alias(c) for c in kept]
        return F.struct(x["seg_id"].alias("seg_id"), last["start_frame"].alias("start_frame"), x["end_excl"].alias("end_excl"), *text)

    kind = out.schema["all"].dataType.elementType.simpleString()
    out = out.filter(F.size("all") > 0).withColumn("all", F.col("all").cast(f"array<{kind}>"))  # so that all fields may be NULL
    text = F.aggregate(F.slice("all", 2, F.size("all")), F.get("all", F.lit(0)), lambda a, x: step(a, x).cast(kind))["instruction"]
    return out.select("sample_id", "seg_id", "start_frame", "end_excl", text.alias("instruction"), "confidence", "support_before", "support_after")


def overcollapsed(merged: DataFrame, light: DataFrame, fps: float = 30.0, texts: DataFrame | None = None) -> DataFrame:
    """Merged segments that hide tasks: three or more source segments, two or more specific texts, and long beside the median. texts
    may be a glossary()."""
    d = (D.glossary(light) if texts is None else texts).select("instruction", "specific")
    seconds = F.greatest(F.lit(0.0), (F.col("end_excl") - F.col("start_frame")) / fps)
    source = light.withColumn("median", F.median(seconds).over(Window.partitionBy("sample_id"))).join(d, "instruction")
    source = source.select("sample_id", F.col("start_frame").alias("s"), F.col("end_excl").alias("e"), "median", F.when(F.col("specific"), F.lower(F.trim("instruction"))).alias("named"))
    met = I.overlapping(merged.select("sample_id", "seg_id", "start_frame", "end_excl"), source, ["sample_id"], ("start_frame", "end_excl", "s", "e"))
    rows = met.groupBy("sample_id", "seg_id", "start_frame", "end_excl").agg(F.count("*").alias("sources"), F.count_distinct("named").alias("texts"), F.first("median").alias("median"))
    return rows.filter((F.col("sources") >= 3) & (F.col("texts") >= 2) & (seconds >= F.greatest(F.lit(10.0), F.col("median") * 1.8))).select("sample_id", "seg_id")


def selection_policies(light: DataFrame, merged: DataFrame, micro: DataFrame, fps: float = 30.0, threshold: float = 0.9, least: int = 8, ratio: float = 0.6, texts: DataFrame | None = None) -> DataFrame:
    """sample_id, policy: whether the merged segments stand, or which guard keeps the light ones. micro(sample_id, point) must all
    stay boundaries, strong boundaries within the peak gap. texts may be a glossary()."""
    kept = S.inner_boundaries(merged)
    strong = S.inner_boundaries(light, threshold).select("sample_id", F.col("frame").alias("point"))
    lost = V.missing(strong, kept, max(1, min(5, round(0.2 * max(fps, 1.0))))).select("sample_id").distinct().withColumn("strong", F.lit(True))
    lost_micro = V.missing(micro.select("sample_id", "point"), kept, 0).select("sample_id").distinct().withColumn("micro", F.lit(True))
    n = light.groupBy("sample_id").agg(F.count("*").alias("n_light")).join(merged.groupBy("sample_id").agg(F.count("*").alias("n_merged")), "sample_id", "left")
    collapsed = overcollapsed(merged, light, fps, texts).select("sample_id").distinct().withColumn("over", F.lit(True))
    rows = n.join(lost, "sample_id", "left").join(lost_micro, "sample_id", "left").join(collapsed, "sample_id", "left")
    few = (F.col("n_light") >= least) & (F.col("n_merged") < S.least_outputs(F.col("n_light"), ratio)) & F.col("over")
    policy = F.when(F.coalesce("n_merged", F.lit(0)) == 0, "light_cleanup_empty_merge").when(F.col("strong"), "light_cleanup_strong_boundary_guard").when(F.col("micro"), "light_cleanup_micro_boundary_guard").when(few, "light_cleanup_fallback").otherwise("merged_default")
    return rows.select("sample_id", policy.alias("policy"))


def assembled(results: DataFrame, windows: DataFrame, samples: DataFrame, frames: int, fps: float = 30.0, threshold: float = 0.9) -> DataFrame:
    """results(sample_id, window_id, repeat_index, result), windows(sample_id, window_id, frame_ids), samples(sample_id, nframes) ->
    sample_id, seg_id, the segment's columns and policy.

    Repeats vote on each window's cuts, and the repeat nearest to the vote gives its texts; cuts weigh by their place in the window and are clustered; close cuts of one window are
    kept apart; labelled frames give each segment its text; long segments are split where the texts drift; cleaned and merged segments
    are held against the guards.
    """
    used = settled(results.filter("result IS NOT NULL").join(windows.select("sample_id", "window_id", "frame_ids"), ["sample_id", "window_id"]))
    said = used.select("sample_id", "window_id", "repeat_index", F.posexplode(F.when(F.size("result.transitions") > 0, F.col("result.transitions")).otherwise(F.array().cast("array<int>"))).alias("k", "place"), "frame_ids")
    usable = used.groupBy("sample_id", "window_id").agg(F.count_distinct("repeat_index").alias("total"))
    named = said.select("sample_id", "window_id", "repeat_index", F.get("frame_ids", F.col("place")).alias("frame")).filter("frame IS NOT NULL")
    cuts = settled(V.repeat_votes(named, usable, fps))
    placed = cuts.join(windows.select("sample_id", "window_id", "frame_ids"), ["sample_id", "window_id"]).withColumn("place", F.array_position("frame_ids", F.col("frame")) - 1)
    whole, size = F.size("frame_ids") == frames, F.size("frame_ids")
    weight = F.when(whole, centre_weight(F.col("place"), size)).when(F.least(F.col("place"), size - 1 - F.col("place")) > 2, 1.0).otherwise(0.5) * F.col("support")
    weighed = placed.select("sample_id", "window_id", "frame", weight.alias("weight"))
    points = V.clusters(weighed, fps)
    ends = samples.select("sample_id", F.explode(F.array(F.lit(0).cast("long"), F.col("nframes"))).alias("point")).unionByName(points.select("sample_id", "point"))
    micro = settled(V.dense_micro(cuts.join(samples, "sample_id"), ends, F.col("nframes"), fps))
    raw_support = weighed.groupBy("sample_id", F.col("frame").alias("point")).agg(F.sum("weight").alias("support"))
    cut = S.from_points(points.unionByName(micro.join(raw_support, ["sample_id", "point"], "left")), samples)
    own = F.filter(F.transform("result.transitions", lambda t: F.get("frame_ids", t)), lambda f: f.isNotNull())
    sources = V.text_sources(used.select("sample_id", "window_id", "repeat_index", own.alias("frames"), F.size("result.instructions").alias("texts")), cuts, fps)
    chosen = used.join(sources, ["sample_id", "window_id", "repeat_index"]).select("sample_id", "window_id", F.col("result").alias("r"), "frame_ids")
    labels = S.labelled_frames(chosen.select("sample_id", "window_id", "frame_ids", F.transform("r.transitions", lambda x: x.cast("long")).alias("transitions"), F.col("r.instructions").alias("instructions")))
    timeline = settled(labels.select("sample_id", "frame", (F.col("window_id") * (1 << 32) + F.col("ord")).alias("ord"), "instruction"))
    raw = settled(cut.join(S.majority_texts(cut, timeline), ["sample_id", "seg_id"]).withColumn("confidence", F.lit(1.0)))
    split = settled(split_on_drift(raw, timeline, fps))
    texts = D.glossary(split)  # later steps choose among these texts
    light = settled(cleaned(split, fps, texts))
    merged = settled(cleaned(D.merge_tasks(light, fps, threshold, texts), fps, texts))
    policy = selection_policies(light, merged, micro, fps, threshold, texts=texts)
    both = light.withColumn("from", F.lit("light")).unionByName(merged.withColumn("from", F.lit("merged")))
    final = both.join(policy, "sample_id").filter(F.col("from") == F.when(F.col("policy") == "merged_default", "merged").otherwise("light"))
    return D.refined_texts(final.drop("from"), light, texts)
