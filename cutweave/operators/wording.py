"""Decisions from texts: neighbours that may merge, the text that stays, and the boundaries that must not go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions import text as T
from ..sources.scratch import settled
from . import intervals as I
from .segments import spelled, support_between


#: So many described texts at most are sent to all tasks, so that rows dealt by sample stay where they are; more meet the rows in shuffles.
MOST_TEXTS = 50_000


def glossary(texts: DataFrame, text: str = "instruction", most: int = MOST_TEXTS) -> DataFrame:
    """Each distinct text described once, and kept. Of dest what may decide a merge, of dest_focus and reference one word."""
    d = T.described(texts.select(text).distinct(), text)
    d = settled(d.withColumns({"dest": T.within(F.col("dest"), [*X.CONTAINER, *X.HEATED]), "dest_focus": F.slice("dest_focus", 1, 1), "reference": F.slice("reference", 1, 1)}))
    return F.broadcast(d) if d.count() <= most else d


def paired(df: DataFrame, left: str, right: str, texts: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """df with both texts described under l_ and r_; each distinct text is described once (texts, by default of df) and joined back."""
    texts = glossary(df.select(F.col(left).alias("instruction")).unionByName(df.select(F.col(right).alias("instruction")))) if texts is None else texts
    named = lambda p: texts.select(*[F.col(c).alias(f"{p}wording" if c == "instruction" else f"{p}{c}") for c in texts.columns])
    return df.join(named("l_"), F.col(left) == F.col("l_wording"), how).join(named("r_"), F.col(right) == F.col("r_wording"), how)


def _followed(segments: DataFrame, *more: Column) -> DataFrame:
    """Each segment with what neighbours() tells of the next one but for texts' descriptions, and its id as __next; NULL for the last."""
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    frames = F.col("end_excl") - F.col("start_frame")
    rows = segments.select("sample_id", "seg_id", F.col("instruction").alias("left_text"), F.lead("instruction").over(w).alias("right_text"), frames.alias("l_frames"), F.lead(frames).over(w).alias("r_frames"), "support_after", F.lead("support_before").over(w).alias("next_before"), F.lead("seg_id").over(w).alias("__next"), *more)
    support, known = support_between(F.col("support_after"), F.col("next_before"))
    return rows.withColumns({"support": support, "known": known})


def neighbours(segments: DataFrame) -> DataFrame:
    """Each segment but the last of its sample with the next one: l_ and r_ texts described, frames of both, support and known."""
    return paired(_followed(segments).filter("__next IS NOT NULL").drop("__next"), "left_text", "right_text", glossary(segments))


def later_text(fps: float, c=F.col) -> Column:
    """Whether the right one of two merged neighbours gives the text: of two different steps with one ingredient, or if it is more
    specific, or as specific and not much shorter. c looks up the columns of neighbours()."""
    seconds = lambda p: F.greatest(F.lit(0.0), c(f"{p}frames") / fps)
    both = lambda n: T.some(T.both(c(f"l_{n}"), c(f"r_{n}")))
    steps = both("ingredients") & c("l_prep_ingredient") & c("r_prep_ingredient") & ~both("actions")
    return steps | (c("r_specificity") > c("l_specificity")) | ((c("r_specificity") == c("l_specificity")) & (seconds("r_") >= 0.75 * seconds("l_")))


def chosen_text(fps: float) -> Column:
    return F.when(later_text(fps), F.col("right_text")).otherwise(F.col("left_text"))


def may_merge(fps: float, threshold: float = 0.9, c=F.col) -> Column:
    """Whether neighbours are one task; c looks up the columns of neighbours().

    A table of reasons, each a condition on what the texts share, on how sure the boundary is and on the lengths in seconds. A
    strong boundary, two ingredients prepared for one dish, or a turn from a general phase to a named ingredient forbid it.
    """
    either = lambda n: c(f"l_{n}") | c(f"r_{n}")
    all_ = lambda n: c(f"l_{n}") & c(f"r_{n}")
    shared = lambda n: T.both(c(f"l_{n}"), c(f"r_{n}"))
    cross = lambda a, b: (c(f"l_{a}") & c(f"r_{b}")) | (c(f"r_{a}") & c(f"l_{b}"))
    sides = lambda f: f("l_", "r_") | f("r_", "l_")
    l_sec, r_sec = F.greatest(F.lit(0.0), c("l_frames") / fps), F.greatest(F.lit(0.0), c("r_frames") / fps)
    shorter, longer = F.least(l_sec, r_sec), F.greatest(l_sec, r_sec)
    # how sure the boundary is
    ceiling = threshold if threshold > 0 else X.SUPPORT_CEILING
    strong = c("known") & (c("support") >= threshold) if threshold > 0 else F.lit(False)
    doubtful = ~c("known") | (c("support") < ceiling)
    seen_doubtful = c("known") & (c("support") < ceiling)
    counted = T.distinct_markers(c("l_markers"), c("r_markers"))
    alike = T.similarity(c("l_primary"), c("r_primary"))
    # what they share
    dish, heat = T.has(shared("dest"), X.CONTAINER), T.has(shared("dest"), X.HEATED)
    food, focus, acts, kinds = T.some(shared("ingredients")), T.some(shared("focus")), T.some(shared("actions")), T.some(shared("families"))
    named = T.some(c("l_ingredients")) & T.some(c("r_ingredients"))
    other_foods = named & ~food
    vague = lambda p: T.some(c(f"{p}reference")) & T.only(c(f"{p}focus"), X.REFERENCE)
    exact = lambda p: ~T.only(c(f"{p}focus"), X.REFERENCE)
    spiced = lambda p: T.some(c(f"{p}ingredients")) & T.only(c(f"{p}ingredients"), X.SEASONING)
    # kinds of relation
    heated_adds = heat & (shared("families") == F.array(F.lit("add"))) & other_foods
    one_dish_focus = dish & focus & ~heated_adds & (kinds | acts | all_("recipe") | cross("mixing", "recipe") | cross("prep_like", "recipe"))
    vague_bridge = dish & sides(lambda p, q: vague(p) & exact(q)) & (kinds | all_("prep_ingredient") | cross("prep_ingredient", "recipe") | cross("prep_ingredient", "mixing"))
    spice_bridge = dish & sides(lambda p, q: spiced(p) & T.some(c(f"{p}dest_focus")) & c(f"{q}mixing") & T.some(c(f"{q}focus")))
    prep_then_use = food & cross("prep_ingredient", "recipe")
    prep_same, prep_other = food & acts & all_("prep_ingredient"), food & all_("prep_ingredient") & ~acts
    two_prepared = dish & all_("recipe") & ~either("mixing") & other_foods & either("prep_ingredient")
    dish_family = dish & all_("recipe") & T.has(shared("families"), ["add", "mix"]) & ~heated_adds & seen_doubtful & ~counted
    to_named = heat & T.has(shared("families"), ["mix", "cook"]) & c("known") & (c("support") >= 1.0) & ~focus & sides(lambda p, q: c(f"{p}phase_noun") & T.some(c(f"{q}focus")))
    linked = (
        (alike >= 0.34) | either("prep_like") | either("filler") | ((one_dish_focus | vague_bridge | spice_bridge) & doubtful) | (dish & either("recipe") & (food | acts) & ~counted)
        | prep_then_use | prep_same | (prep_other & c("known") & ~strong) | dish_family
    )
    forbidden = ~linked | strong | two_prepared | to_named
    at_once = (one_dish_focus & doubtful & (longer <= 18.0)) | (vague_bridge & doubtful & (shorter <= 4.5) & (longer <= 14.0)) | (spice_bridge & doubtful & (shorter <= 12.0) & (longer <= 18.0))
    brief = lambda p, s: c(f"{p}generic") & (s <= 4.5) & ~(c(f"{p}prep_like") | c(f"{p}filler"))
    in_dish = dish & either("recipe") & ~counted & ((food & (shorter <= 8.0)) | (acts & (longer <= 8.0)) | (either("mixing") & food & (longer <= 20.0)))
    later = (
        (all_("generic") & ~(either("prep_like") | either("filler"))) | brief("l_", l_sec) | brief("r_", r_sec) | in_dish | ((prep_then_use | prep_same) & (shorter <= 8.0))
        | (dish_family & (shorter <= 16.0)) | ((alike >= 0.6) & (shorter <= 6.5) & ~counted)
    )
    return ~forbidden & (at_once | F.when(prep_other, c("known") & (shorter <= 8.0)).otherwise(later))


def round_key(instruction: Column) -> Column:
    """The words of a text without those that count rounds of a step."""
    words = F.regexp_extract_all(F.lower(F.trim(instruction)), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_join(F.filter(words, lambda w: ~w.isin(*X.ROUND)), " ")


def rounds_only(left: Column, right: Column) -> Column:
    """Whether two texts differ, but in the words alone that count rounds."""
    return (F.lower(F.trim(left)) != F.lower(F.trim(right))) & (round_key(left) == round_key(right)) & (round_key(left) != "")


def _scored(n: DataFrame, support: float, by_support: bool = True, by_markers: bool = True, by_drift: bool = True) -> DataFrame:
    """n, neighbours, with what blocked_boundaries() tells of each, and each reason as strong, mark and drift."""
    some = lambda c: F.coalesce(c, F.lit(False))
    marks = T.distinct_markers(F.col("l_markers"), F.col("r_markers")) if by_markers else F.lit(False)
    drift = T.drifts("l_", "r_") if by_drift else F.lit(False)
    rows = n.withColumns({"strong": some(F.col("known") & (F.col("support") >= support) & F.lit(by_support)), "mark": some(marks), "drift": some(drift)})
    rows = rows.withColumn("round_only", F.when(F.col("mark"), rounds_only(F.col("left_text"), F.col("right_text"))).otherwise(False))  # texts are dear to compare
    left, right = F.greatest("l_frames", F.lit(1)), F.greatest("r_frames", F.lit(1))
    rows = rows.withColumn("turns", F.col("drift").cast("int") + (F.col("mark") & ~F.col("round_only")).cast("int"))
    return rows.withColumns({"shorter": F.least(left, right), "frames": left + right, "score": F.col("support") + 0.5 * F.col("turns")})


def blocked_boundaries(segments: DataFrame, support: float, by_support: bool = True, by_markers: bool = True, by_drift: bool = True) -> DataFrame:
    """Inner boundaries that have a reason to be kept (support, sequence, drift, each if it is asked for), with round_only, where the
    sequence is of rounds alone, and a score: support plus a half for drift, and for sequence unless of rounds alone."""
    rows = _scored(neighbours(segments), support, by_support, by_markers, by_drift).filter("strong OR mark OR drift")
    held = F.array_compact(F.array(F.when(F.col("strong"), "support"), F.when(F.col("mark"), "sequence"), F.when(F.col("drift"), "drift")))
    return rows.select("sample_id", "seg_id", F.array_join(held, ",").alias("reasons"), "round_only", "support", "shorter", "frames", "turns", "score")


#: What a text says that refined_texts() asks for, and what spaced_anchors() asks of a boundary.
SAID, HELD = ["specificity", "generic", "prep_like", "filler", "specific"], ["score", "turns", "support", "shorter", "frames"]


def listed(segments: DataFrame, support: float, tails: bool = False) -> DataFrame:
    """sample_id, n, segs: a row for each sample with its n segments in order. Each has its columns, what its text says (SAID, NULL for no
    text), and held, as blocked_boundaries() scores the boundary after it, NULL if nothing keeps it. With tails also turn, whether that
    boundary is one of sequence or task, and again, whether its text repeats the one before.

    Rows that are dealt by sample stay where they are, so all that a pass asks of a sample is told by this row and nothing is dealt again.
    """
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    key = T.key_of(F.col("instruction"))
    own = [c for c in segments.columns if c not in ("sample_id", "seg_id")]
    again = [(key == F.lag(key).over(w)).alias("again")] if tails else []
    rows = _scored(paired(_followed(segments, F.struct(*own).alias("__own"), *again), "left_text", "right_text", glossary(segments), "left"), support)
    inner = F.col("__next").isNotNull() & F.col("l_wording").isNotNull() & F.col("r_wording").isNotNull()
    held = F.when(inner & (F.col("strong") | F.col("mark") | F.col("drift")), F.struct(*HELD)).alias("held")
    turn = [(inner & (F.col("mark") | F.col("drift"))).alias("turn"), "again"] if tails else []
    item = F.struct("seg_id", *[F.col(f"__own.{c}").alias(c) for c in own], *[F.col(f"l_{c}").alias(c) for c in SAID], held, *turn)
    return rows.groupBy("sample_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(item)).alias("segs"))


def dominant_texts(candidates: DataFrame) -> DataFrame:
    """candidates(sample_id, instruction, ord) -> the most frequent text of each sample, then the most specific, then with more
    ingredients and kinds of action, then the first seen."""
    n = candidates.groupBy("sample_id", "instruction").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    d = glossary(candidates)
    rank = F.struct((-F.col("n")).alias("a"), (-F.col("specificity")).alias("b"), (-F.size("ingredients")).alias("c"), (-F.size("families")).alias("d"), F.col("first").alias("e"))
    return n.join(d, "instruction").groupBy("sample_id").agg(F.min_by("instruction", rank).alias("instruction"))


def refined_texts(final: DataFrame, source: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """final with each text replaced by that of the best overlapping source segment, where that is specific and either the own text is
    not or the overlap is 0.45 of the segment or more. Best: frames in common, 24 for each step of specificity, 18 for the same
    text, less 12, 16 and 24 for generic, preparing and filling ones; the earlier of equals. texts may be a glossary() of both."""
    d = (glossary(source.select("instruction").unionByName(final.select("instruction"))) if texts is None else texts).select("instruction", "specificity", "generic", "prep_like", "filler", "specific")
    f = final.join(d.select("instruction", F.col("specific").alias("own_specific")), "instruction").select(*final.columns, "own_specific")
    s = source.join(d, "instruction").select("sample_id", F.col("seg_id").alias("src"), F.col("start_frame").alias("s"), F.col("end_excl").alias("e"), F.col("instruction").alias("txt"), "specificity", "generic", "prep_like", "filler", "specific")
    met = I.overlapping(f, s, ["sample_id"], ("start_frame", "end_excl", "s", "e"), every=True)
    overlap = (F.least("end_excl", "e") - F.greatest("start_frame", "s")).cast("double")
    less = lambda name, by: F.when(F.col(name), by).otherwise(0.0)
    score = overlap + 24.0 * F.col("specificity") + F.when(F.col("txt") == F.col("instruction"), 18.0).otherwise(0.0) - less("generic", 12.0) - less("prep_like", 16.0) - less("filler", 24.0)
    rank = F.when(F.col("src").isNotNull(), F.struct((-score).alias("a"), "src"))
    keys = ["sample_id", "seg_id", "start_frame", "end_excl", "instruction", "own_specific"]
    best = met.groupBy(*keys).agg(F.min_by(F.struct("txt", "specific", overlap.alias("overlap")), rank).alias("best"), *[F.first(c).alias(c) for c in final.columns if c not in keys])
    take = F.col("best.specific") & (~F.col("own_specific") | (F.col("best.overlap") / F.greatest(F.lit(1.0), F.col("end_excl") - F.col("start_frame")) >= 0.45))
    text = F.when(F.coalesce(take, F.lit(False)), F.col("best.txt")).otherwise(F.col("instruction"))
    return best.select(*[text.alias(c) if c == "instruction" else F.col(c) for c in final.columns])


def merge_tasks(segments: DataFrame, fps: float = 30.0, threshold: float = 0.9, texts: DataFrame | None = None) -> DataFrame:
    """Joins neighbours that are one task, from the left: each segment is held against what those before it have become.

    The joined segment ends where the right one does, has its support after and the better confidence of both, and the text of
    the one that later_text() names. A sample's segments are folded in one array, samples in parallel; they are dealt by
    sample before they carry what their texts say. texts may be a glossary().
    """
    d = glossary(segments) if texts is None else texts
    kept = [c for c in d.columns if c not in ("tokens", "all_words", "head", "subject", "dest_food", "specific")]
    spans = ["start_frame", "end_excl", "confidence", "support_before", "support_after"]
    rows = segments.repartition("sample_id").join(d, "instruction").withColumn("frames", F.col("end_excl") - F.col("start_frame"))
    listed = rows.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("seg_id", "frames", *spans, *kept))).alias("all"))
    item = listed.schema["all"].dataType.elementType.simpleString()
    listed = listed.withColumn("all", F.col("all").cast(f"array<{item}>"))  # so that all fields may be NULL

    def fold(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        support, known = support_between(last["support_after"], x["support_before"])
        look = lambda name: support if name == "support" else known if name == "known" else (last if name[:2] == "l_" else x)[name[2:]]
        right = later_text(fps, look)
        text = [F.when(right, x[k]).otherwise(last[k]).alias(k) for k in kept]
        joined = F.struct(last["seg_id"].alias("seg_id"), (x["end_excl"] - last["start_frame"]).alias("frames"), last["start_frame"].alias("start_frame"), x["end_excl"].alias("end_excl"), F.greatest(last["confidence"], x["confidence"]).alias("confidence"), last["support_before"].alias("support_before"), x["support_after"].alias("support_after"), *text)
        into = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined.cast(item)))
        return F.when(may_merge(fps, threshold, look), into).otherwise(F.concat(done, F.array(x)))

    folded = F.aggregate(F.slice("all", 2, F.size("all")), F.slice("all", 1, 1), fold)
    return listed.select("sample_id", F.posexplode(folded).alias("seg_id", "s")).select("sample_id", F.col("seg_id").cast("long").alias("seg_id"), *[F.col(f"s.{c}").alias(c) for c in ("start_frame", "end_excl", "instruction", "confidence", "support_before", "support_after")])


def spaced_anchors(boundaries: DataFrame, ranges: DataFrame, limit: int = 1, spacing: int = 3, side: int = 2, least: float = 1.03) -> DataFrame:
    """boundaries(sample_id, seg_id, reasons, score, support, shorter, frames), ranges(sample_id, start_idx, end_idx) -> the anchors of
    each range: by rank, those with the least score or more and enough segments at both sides, not nearer than spacing to one
    that was taken, until the limit. Long ranges rank balance first and take more."""
    long_from = max(10, 4 * spacing)
    met = boundaries.join(spelled(ranges), ["sample_id", "seg_id"]).filter("seg_id < end_idx")
    n = F.col("end_idx") - F.col("start_idx") + 1
    balance = F.least(F.col("seg_id") - F.col("start_idx") + 1, F.col("end_idx") - F.col("seg_id"))
    rank = F.struct(F.when(n >= long_from, -balance).otherwise(0).alias("a"), (-F.col("score")).alias("b"), (-F.col("turns")).alias("c"), (-F.col("support")).alias("d"), (-F.col("shorter")).alias("e"), (-F.col("frames")).alias("f"), F.col("seg_id").alias("g"))
    fit = met.filter((F.col("score") >= least) & (balance >= side))
    most = F.when(n >= long_from, F.greatest(F.lit(limit), F.ceil((n - 1) / (2 * spacing)).cast("int"))).otherwise(limit)
    listed = fit.groupBy("sample_id", "start_idx", "end_idx").agg(F.transform(F.array_sort(F.collect_list(rank)), lambda r: r["g"]).alias("ranked")).withColumn("most", most)
    take = lambda got, b: F.when((F.size(got) < F.col("most")) & F.forall(got, lambda g: F.abs(g - b) >= spacing), F.concat(got, F.array(b))).otherwise(got)
    return listed.select("sample_id", "start_idx", "end_idx", F.explode(F.array_sort(F.aggregate("ranked", F.array().cast("array<bigint>"), take))).alias("boundary"))


def anchors(segs: Column, start: Column, end: Column, limit: int = 1, spacing: int = 3, side: int = 2, least: float = 1.03) -> Column:
    """spaced_anchors() of one range from start to end among the segments of listed()."""
    long_from, n = max(10, 4 * spacing), end - start + 1
    balance = lambda x: F.least(x["seg_id"] - start + 1, end - x["seg_id"])
    fit = F.filter(segs, lambda x: x["held"].isNotNull() & (x["seg_id"] >= start) & (x["seg_id"] < end) & (x["held"]["score"] >= least) & (balance(x) >= side))
    rank = lambda x: F.struct(F.when(n >= long_from, -balance(x)).otherwise(F.lit(0).cast("long")).alias("a"), *[(-x["held"][c]).alias(c) for c in HELD], x["seg_id"].alias("g"))
    ranked = F.transform(F.array_sort(F.transform(fit, rank)), lambda r: r["g"])
    most = F.when(n >= long_from, F.greatest(F.lit(limit), F.ceil((n - 1) / (2 * spacing)).cast("int"))).otherwise(limit)
    take = lambda got, b: F.when((F.size(got) < most) & F.forall(got, lambda g: F.abs(g - b) >= spacing), F.concat(got, F.array(b))).otherwise(got)
    return F.aggregate(ranked, F.array().cast("array<bigint>"), take)


def text_among(segs: Column, start: Column, end: Column, own: Column, own_specific: Column) -> Column:
    """refined_texts() of one span of frames with the text own, among the segments of listed()."""
    less = lambda c, by: F.when(c, by).otherwise(0.0)
    overlap = lambda x: (F.least(end, x["end_excl"]) - F.greatest(start, x["start_frame"])).cast("double")
    score = lambda x: overlap(x) + 24.0 * x["specificity"] + less(x["instruction"] == own, 18.0) - less(x["generic"], 12.0) - less(x["prep_like"], 16.0) - less(x["filler"], 24.0)
    met = F.filter(segs, lambda x: x["specific"].isNotNull() & (x["start_frame"] < end) & (start < x["end_excl"]))
    best = F.array_min(F.transform(met, lambda x: F.struct((-score(x)).alias("a"), x["seg_id"].alias("src"), x["instruction"].alias("text"), x["specific"].alias("specific"), overlap(x).alias("overlap"))))
    # in an array of one, so that the best is looked for once
    told = F.transform(F.array(best), lambda b: F.when(F.coalesce(b["specific"] & (~own_specific | (b["overlap"] / F.greatest(F.lit(1.0), end - start) >= 0.45)), F.lit(False)), b["text"]).otherwise(own))
    return F.get(told, F.lit(0))


def duplicate_tails(segments: DataFrame, ranges: DataFrame, least_frames: int = 5, again: DataFrame | None = None) -> DataFrame:
    """Splits the last segment off a range where it repeats the text before it, is long enough, and the boundary after the range is
    a turn of sequence or task. again(sample_id, end_idx, again) may say which segments repeat the one before."""
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    tails = segments.select("sample_id", F.col("seg_id").alias("end_idx"), (F.col("end_excl") - F.col("start_frame") >= least_frames).alias("long"), (T.key_of(F.col("instruction")) == F.lag(T.key_of(F.col("instruction"))).over(w)).alias("again"))
    tails = tails if again is None else tails.drop("again").join(again, ["sample_id", "end_idx"])
    n = neighbours(segments)
    turns = n.select("sample_id", F.col("seg_id").alias("end_idx"), (T.distinct_markers(F.col("l_markers"), F.col("r_markers")) | T.drifts("l_", "r_")).alias("turn"))
    met = ranges.join(tails, ["sample_id", "end_idx"], "left").join(turns, ["sample_id", "end_idx"], "left")
    split = F.coalesce((F.col("end_idx") > F.col("start_idx")) & F.col("long") & F.col("again") & F.col("turn"), F.lit(False))
    one, two = F.struct("start_idx", "end_idx"), F.array(F.struct("start_idx", (F.col("end_idx") - 1).alias("end_idx")), F.struct(F.col("end_idx").alias("start_idx"), "end_idx"))
    return met.select("sample_id", F.explode(F.when(split, two).otherwise(F.array(one))).alias("r")).select("sample_id", "r.*")
