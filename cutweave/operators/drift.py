"""Long segments split where what is done changes: runs of like texts along the timeline, and the best place between two of them.

A segment is known by its sample and first frame. It is one row with the frames of each text as an array, so frames and bins are never dealt, nor kept
as rows: runs are found by sorting the frames of a batch of segments, in Arrow tasks, and all else is told by a segment's own row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions import text as T
from ..sources.scratch import settled
from . import intervals as I

KEYS = ["sample_id", "start_frame"]
#: So many texts at most are sent to all tasks.
MOST_TEXTS = 50_000


def _with(value: Column, f) -> Column:
    """f(value), with value made once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def told(described: DataFrame) -> DataFrame:
    """instruction, t: what is asked here of each described text, as one struct; kept."""
    c = F.col
    families, ingredients = c("families"), c("ingredients")
    done = F.when(T.some(families), families).otherwise(F.array_sort(c("actions")))
    things = F.when(T.some(ingredients), ingredients).otherwise(T.without(c("primary"), X.CONTAINER))
    sauce = T.some(families) & T.only(families, ["add", "cook", "mix"]) & T.has(ingredients, X.SAUCE_BASE) & T.only(ingredients, [*X.SAUCE_BASE, "sauteed"])
    context = T.within(c("dest"), X.CONTAINER)
    t = F.struct(
        c("instruction").alias("text"), F.struct((-c("specificity")).alias("b"), (-F.size("ingredients")).alias("c"), (-F.size("families")).alias("d")).alias("facts"), F.array_sort(context).alias("context"),
        T.has(c("all_words"), [*X.SAUCE_BASE, "sausage"]).alias("asks"), F.coalesce(sauce, F.lit(False)).alias("sauce"), F.array_join(done, ",").alias("done"), F.array_join(F.slice(F.array_sort(things), 1, 2), ",").alias("things"),
        "families", "focus", "primary", "specific",
    )
    d = settled(described.select("instruction", t.alias("t")))
    return F.broadcast(d) if d.count() <= MOST_TEXTS else d


def phase_signature(t: Column, context: Column) -> Column:
    """What a text, as told() has it, is about: its kinds of action (else its actions), its first container, and the first two of its
    ingredients (else objects). A text that names none takes its containers from context if it speaks of a sauce; sauces that are
    begun alike in a pan or pot are one phase."""
    place = F.when(T.some(t["context"]), t["context"]).when(t["asks"], context).otherwise(F.array().cast("array<string>"))
    first = lambda p: F.array_join(F.slice(p, 1, 1), ",")
    return _with(place, lambda p: F.when(t["sauce"] & T.has(p, X.HEATED), F.concat_ws("|", F.lit("sauce_base"), first(p), F.lit("sauce_base"))).otherwise(F.concat_ws("|", t["done"], first(p), t["things"])))


def _step(fps: float, bin_sec: float = 2.0) -> int:
    return max(1, round(max(0.5, bin_sec) * max(fps, 1.0)))


RUN = "array<struct<run:bigint,run_start:bigint,run_end:bigint,k:int>>"


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys begin anew."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    return changed


def _runs(step: int):
    """with_runs() for the rows of a batch at once: sorts and counts over all their frames."""

    def found(start: pa.Array, end: pa.Array, labels: pa.Array, size: pa.Array) -> pa.Array:
        number = lambda x: x.to_numpy(zero_copy_only=False)
        sizes = lambda lists: number(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
        code = lambda x: number(pc.fill_null(pc.dictionary_encode(x).indices, -1))
        s, e, per_row, x = number(start), number(end), number(size).astype(np.int64), labels.flatten()
        text, sign = code(x.field("text")), code(x.field("signature"))
        order, *facts = (number(x.field(c)) for c in ("ord", "b", "c", "d"))
        row_of = np.repeat(np.arange(len(s)), per_row)
        k, frame = np.repeat(np.arange(len(row_of)), sizes(x.field("frames"))), number(x.field("frames").flatten())
        inside = (frame >= s[row_of[k]]) & (frame < e[row_of[k]])
        k, frame = k[inside], frame[inside]
        row = row_of[k]
        bin_ = (frame - s[row]) // step
        # texts of a bin, each with the number of its frames and where it is seen first
        by = np.lexsort((order[k], frame, text[k], bin_, row))
        k, frame, bin_, row = (v[by] for v in (k, frame, bin_, row))
        head = np.flatnonzero(_first_of(row, bin_, text[k]))
        n = np.diff(np.append(head, len(k)))
        k, frame, bin_, row = (v[head] for v in (k, frame, bin_, row))
        # the dominant one of each bin
        by = np.lexsort((order[k], frame, *[f[k] for f in facts[::-1]], -n, bin_, row))
        best = by[_first_of(row[by], bin_[by])]
        k, bin_, row = k[best], bin_[best], row[best]
        # runs of one signature, and the dominant text of each
        run = np.cumsum(_first_of(row, sign[k])) - 1
        begin = np.flatnonzero(_first_of(run))
        until = np.append(begin[1:], len(run))[: len(begin)] - 1
        by = np.lexsort((bin_, text[k], run))
        head = np.flatnonzero(_first_of(run[by], text[k][by]))
        n, mine = np.diff(np.append(head, len(by))), by[head]
        ranked = np.lexsort((bin_[mine], *[f[k[mine]] for f in facts[::-1]], -n, run[mine]))
        named = k[mine[ranked[_first_of(run[mine[ranked]])]]]
        row, lo, hi = row[begin], bin_[begin], bin_[until]
        count = np.bincount(row, minlength=len(s))
        before, base = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(per_row))
        made = [np.arange(len(row)) - before[row] + 1, s[row] + lo * step, np.minimum(s[row] + (hi + 1) * step, e[row]), (named - base[row]).astype(np.int32)]
        return pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.StructArray.from_arrays([pa.array(v) for v in made], ["run", "run_start", "run_end", "k"]))

    # its types are told to Spark here, since annotations are texts in this file
    found.__annotations__ = {"start": pa.Array, "end": pa.Array, "labels": pa.Array, "size": pa.Array, "return": pa.Array}
    return F.arrow_udf(found, RUN)


def with_runs(rows: DataFrame, asked: Column, step: int) -> DataFrame:
    """rows of labelled() with runs, in order: run (from 1), run_start, run_end, and k, the place of a label with its text. None where it isn't asked.

    The segment's frames fall into bins of step frames; each bin with labels has its dominant text; neighbouring such bins of one signature are a
    run, whose text is the dominant one of its bins. Dominant: the most frequent, then most specific, then with more ingredients and kinds
    of action, then the first seen.
    """
    number = lambda c: c.cast("long")
    item = lambda x: F.struct(x["t"]["text"].alias("text"), phase_signature(x["t"], F.col("context")).alias("signature"), number(x["ord"]).alias("ord"), *[number(x["t"]["facts"][c]).alias(c) for c in "bcd"], x["frames"].alias("frames"))
    rows = rows.withColumn("asked", F.when(asked & F.col("context").isNotNull(), F.transform("labels", item)))
    # asked is read twice, so it stays a step of its own: an Arrow function whose argument holds a lambda is not run
    return rows.withColumn("runs", _runs(step)(number(F.col("start_frame")), number(F.col("end_excl")), F.col("asked"), F.coalesce(F.size("asked"), F.lit(0)))).drop("asked")


def labelled(segments: DataFrame, timeline: DataFrame, texts: DataFrame) -> DataFrame:
    """segments(sample_id, start_frame, end_excl, ...) with context, the containers that their text names, and labels: the frames of timeline(sample_id, frame,
    ord, instruction) that each holds, as with_runs() asks for them. Segments without frames have no labels; context is NULL for those without a described text."""
    frames = timeline.select("sample_id", "frame", "ord", "instruction")
    inside = I.holding(frames, segments.select(*KEYS, "end_excl"), ["sample_id"], "frame", "start_frame", "end_excl")
    given = inside.groupBy(*KEYS, "instruction", "ord").agg(F.collect_list(F.col("frame").cast("long")).alias("frames")).join(texts, "instruction")
    given = given.groupBy(*KEYS).agg(F.collect_list(F.struct("t", "ord", "frames")).alias("labels"))
    own = texts.select(F.col("instruction").alias("own"), F.col("t.context").alias("context"))
    rows = segments.join(own, F.col("instruction") == F.col("own"), "left").drop("own")
    # by sample alone, as both sides are dealt: with start_frame as a key both would be dealt again
    both = I.beside(rows, given, ["sample_id"]).withColumn("at", F.coalesce("__a.start_frame", "__b.start_frame"))
    both = both.withColumn("b", F.first("__b", True).over(Window.partitionBy("sample_id", "at"))).filter("__a IS NOT NULL")
    return both.select("sample_id", *[f"__a.{c}" for c in rows.columns if c != "sample_id"], "b.labels")


def listed_runs(rows: DataFrame, fps: float = 30.0, bin_sec: float = 2.0) -> DataFrame:
    """instruction_runs() of rows of labelled()."""
    rows = with_runs(rows, F.lit(True), _step(fps, bin_sec))
    runs = F.transform("runs", lambda x: F.struct(*[x[c].alias(c) for c in ("run", "run_start", "run_end")], F.get("labels", x["k"])["t"]["text"].alias("instruction")))
    return rows.select(*KEYS, "end_excl", F.inline(runs))


def instruction_runs(segments: DataFrame, timeline: DataFrame, described: DataFrame, fps: float = 30.0, bin_sec: float = 2.0) -> DataFrame:
    """segments(sample_id, start_frame, end_excl, instruction), timeline(sample_id, frame, ord, instruction) -> sample_id,
    start_frame, end_excl, run (from 1), run_start, run_end, instruction.

    A segment's frames fall into bins of bin_sec seconds; each bin with labels has its dominant text; neighbouring such bins of one
    signature are a run, whose text is the dominant one of its bins. described holds the distinct texts of both, described.
    """
    return listed_runs(labelled(segments.select(*KEYS, "end_excl", "instruction"), timeline, told(described)), fps, bin_sec)


def with_split(rows: DataFrame, fps: float, segment_sec: float, phase_sec: float) -> DataFrame:
    """rows of labelled() with split, NULL for none: boundary, left and right, t of both texts of the best boundary of a segment of segment_sec and more that holds two phases.

    Both runs and both parts last phase_sec at least and the texts drift. The best boundary has the longest shorter run; other kinds
    of action count as a phase more, a specific text as a quarter of one; the first of equals.
    """
    least, phase = max(1, round(segment_sec * fps)), max(1, round(phase_sec * fps))
    start, end = F.col("start_frame"), F.col("end_excl")
    rows = with_runs(rows, end - start >= least, _step(fps))
    more = lambda c, by: F.when(c, by).otherwise(0.0)

    def pair(x: Column, y: Column) -> Column:
        shorter = F.least(x["run_end"] - x["run_start"], y["run_end"] - y["run_start"])
        boundary = F.floor((x["run_end"] + y["run_start"]) / 2).cast("long")
        t = lambda z: F.get("labels", z["k"])["t"]
        look = lambda name: t(x if name[:2] == "l_" else y)[name[2:]]
        score = shorter + more(look("l_families") != look("r_families"), float(phase)) + more(look("l_specific"), 0.25 * phase) + more(look("r_specific"), 0.25 * phase)
        fits = (shorter >= phase) & (boundary - start >= phase) & (end - boundary >= phase)
        return F.when(fits & T.drifts("l_", "r_", look), F.struct((-score).alias("a"), x["run"].alias("run"), boundary.alias("boundary"), x["k"].alias("left"), y["k"].alias("right")))

    pairs = lambda all_: F.array_compact(F.transform(all_, lambda x, i: F.when(i < F.size(all_) - 1, pair(x, F.get(all_, i + 1)))))
    best = _with(F.array_min(pairs(F.col("runs"))), lambda s: F.when(s.isNotNull(), F.struct(s["boundary"].alias("boundary"), F.get("labels", s["left"])["t"].alias("left"), F.get("labels", s["right"])["t"].alias("right"))))
    return rows.withColumn("split", best).drop("runs")


def listed_splits(rows: DataFrame, fps: float, segment_sec: float, phase_sec: float) -> DataFrame:
    """best_splits() of rows of labelled()."""
    found = with_split(rows, fps, segment_sec, phase_sec)
    one = F.when(F.col("split").isNotNull(), F.array(F.struct("split.boundary", F.col("split.left.text").alias("left_text"), F.col("split.right.text").alias("right_text"))))
    return found.select(*KEYS, F.inline(one))


def best_splits(segments: DataFrame, timeline: DataFrame, described: DataFrame, fps: float, segment_sec: float, phase_sec: float) -> DataFrame:
    """sample_id, start_frame, boundary, left_text, right_text of the segments of segment_sec and more that hold two phases, as with_split() finds them."""
    least = max(1, round(segment_sec * fps))
    long = segments.filter(F.col("end_excl") - F.col("start_frame") >= least).select(*KEYS, "end_excl", "instruction")
    return listed_splits(labelled(long, timeline, told(described)), fps, segment_sec, phase_sec)


def listed_parts(rows: DataFrame, fps: float = 30.0, segment_sec: float = 30.0, phase_sec: float = 5.0, depth: int = 3) -> DataFrame:
    """split_on_drift() of rows of labelled()."""
    kept = [c for c in rows.columns if c not in ("context", "labels")]
    # what is too short, or was not split, is not looked at again, so its labels go
    least, none = max(1, round(segment_sec * fps)), F.lit(None).cast(rows.schema["labels"].dataType)
    rows = rows.withColumn("labels", F.when(F.col("end_excl") - F.col("start_frame") >= least, F.col("labels")))
    for _ in range(depth):
        found = with_split(rows, fps, segment_sec, phase_sec)
        same = {c: F.col(c) for c in rows.columns if c != "sample_id"}
        part = lambda **new: F.struct(*[c.alias(k) for k, c in (same | new).items()])  # noqa: B023, E731
        cut, zero = F.col("split.boundary"), F.lit(0.0)
        side = lambda c, t: {"instruction": F.col(f"split.{t}.text"), "context": F.col(f"split.{t}.context"), **c}
        parts = F.when(F.col("split").isNull(), F.array(part(labels=none))).otherwise(F.array(part(**side({"end_excl": cut, "support_after": zero}, "left")), part(**side({"start_frame": cut, "support_before": zero}, "right"))))
        rows = found.select("sample_id", F.inline(parts))  # by sample as before
    return rows.select(*kept).withColumn("seg_id", (F.row_number().over(Window.partitionBy("sample_id").orderBy("start_frame")) - 1).cast("long"))


def split_on_drift(segments: DataFrame, timeline: DataFrame, fps: float = 30.0, segment_sec: float = 30.0, phase_sec: float = 5.0, depth: int = 3) -> DataFrame:
    """segments with the long ones split, each part again, depth times at most; seg_id counts anew.

    The inner supports of a split are 0, all else is the segment's own. A part that isn't split stays as it is in later rounds.
    Segments without labelled frames stay whole; an empty table gives no rows.
    """
    texts = told(T.described(segments.select("instruction").unionByName(timeline.select("instruction")).distinct()))
    return listed_parts(labelled(segments, timeline, texts), fps, segment_sec, phase_sec, depth)
