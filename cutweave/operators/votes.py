"""Cut votes: gap islands, repeat votes within a window, clusters of cuts, and the support around cut points.

All groups are a sample's frames or a window's; equal keys are summed before they are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def peak_gap(fps: float) -> int:
    """Frames that two votes of one peak may lie apart: a fifth of a second, from 2 to 5."""
    return max(2, min(5, round(0.2 * fps)))


def micro_gap(fps: float) -> int:
    return max(1, min(5, round(0.15 * (fps if fps > 1e-6 else 30.0))))


def islands(df: DataFrame, keys: list[str], order: str, gap: int, name: str = "island") -> DataFrame:
    """Numbers the runs of rows, per keys in order, whose neighbours lie at most gap apart."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = F.coalesce((F.col(order) - F.lag(order).over(w) > gap).cast("long"), F.lit(0))
    return df.withColumn("__new", new).withColumn(name, F.sum("__new").over(w)).drop("__new")


def repeat_votes(votes: DataFrame, repeats: DataFrame, fps: float = 30.0) -> DataFrame:
    """votes(sample_id, window_id, repeat_index, frame), repeats(sample_id, window_id, total) -> sample_id, window_id, frame, support.

    total counts the usable repeats of a window, those that saw no cut included. Repeats vote on cuts: frames within the peak
    gap are one cut, at the frame of most repeats, then most votes, then the earliest; its support is the share of usable repeats
    that name it. A window with one usable repeat keeps all its frames.
    """
    keys = ["sample_id", "window_id"]
    each = votes.groupBy(*keys, "frame").agg(F.collect_set("repeat_index").alias("repeats"), F.count("*").alias("n"))
    lone = each.join(repeats.filter("total = 1"), keys).select(*keys, "frame", F.lit(1.0).alias("support"))
    runs = islands(each.join(repeats.filter("total > 1"), keys), keys, "frame", peak_gap(fps))
    best = F.min(F.struct((-F.size("repeats")).alias("r"), (-F.col("n")).alias("n"), "frame"))
    cut = runs.groupBy(*keys, "island", "total").agg(best.alias("best"), F.array_distinct(F.flatten(F.collect_list("repeats"))).alias("repeats"))
    return lone.unionByName(cut.select(*keys, F.col("best.frame").alias("frame"), (F.size("repeats") / F.col("total")).alias("support")))


def text_sources(records: DataFrame, cuts: DataFrame, fps: float = 30.0) -> DataFrame:
    """records(sample_id, window_id, repeat_index, frames, texts), cuts(sample_id, window_id, frame) -> sample_id, window_id,
    repeat_index: the repeat whose texts stand for the window. frames are its own cuts, texts the number of its texts.

    It is the one with most voted cuts within the peak gap of its own, then the least sum of distances to them (without cuts, the gap
    and one for each), then the nearest number of cuts, then most texts, then the first. Where nothing was voted, the one with
    fewest cuts, then fewest texts, then the first.
    """
    keys, gap = ["sample_id", "window_id"], peak_gap(fps)
    rows = records.join(cuts.groupBy(*keys).agg(F.collect_list("frame").alias("voted")), keys, "left")
    far = F.transform("voted", lambda v: F.coalesce(F.array_min(F.transform("frames", lambda f: F.abs(f - v))), F.lit(gap + 1).cast("long")))
    hits = F.when(F.size("frames") > 0, F.size(F.filter("far", lambda d: d <= gap))).otherwise(0)
    put = lambda a, b, c, d: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), c.cast("long").alias("c"), d.cast("long").alias("d"))
    own, zero = F.size("frames"), F.lit(0)
    named = put(-hits, F.aggregate("far", F.lit(0).cast("long"), lambda t, d: t + d), F.abs(own - F.size("voted")), -F.col("texts"))
    score = F.when(F.col("voted").isNull(), put(own, zero, zero, F.col("texts"))).otherwise(named)
    return rows.withColumn("far", far).groupBy(*keys).agg(F.min_by("repeat_index", F.struct(score.alias("score"), "repeat_index")).alias("repeat_index"))


def accumulated(votes: DataFrame) -> DataFrame:
    """votes(sample_id, frame, weight, window_id) -> for each frame its votes, summed weight and number of windows."""
    return votes.groupBy("sample_id", "frame").agg(F.count("*").alias("n"), F.sum("weight").alias("support"), F.count_distinct("window_id").alias("windows"))


def clusters(votes: DataFrame, fps: float = 30.0) -> DataFrame:
    """votes(sample_id, frame, weight) -> sample_id, point, support: one point for each peak, at the frame of most votes, then most
    weight, then the earliest, with the weight of the whole peak."""
    each = votes.groupBy("sample_id", "frame").agg(F.count("*").alias("n"), F.sum("weight").alias("support"))
    runs = islands(each, ["sample_id"], "frame", peak_gap(fps))
    best = F.min(F.struct((-F.col("n")).alias("n"), (-F.col("support")).alias("s"), "frame"))
    return runs.groupBy("sample_id", "island").agg(best.alias("best"), F.sum("support").alias("support")).select("sample_id", F.col("best.frame").alias("point"), "support")


def merged_points(points: DataFrame, gap: int) -> DataFrame:
    """points(sample_id, point, support) -> the strongest, then earliest, point of each run within gap, with its own support."""
    runs = islands(points, ["sample_id"], "point", gap)
    return runs.groupBy("sample_id", "island").agg(F.min(F.struct((-F.col("support")).alias("s"), "point")).alias("b")).select("sample_id", F.col("b.point").alias("point"), (-F.col("b.s")).alias("support"))


def neighbourhood(points: DataFrame, gap: int) -> DataFrame:
    """Adds around: the support of all points of the sample within gap, itself included."""
    w = Window.partitionBy("sample_id").orderBy("point").rangeBetween(-gap, gap)
    return points.withColumn("around", F.sum("support").over(w))


def near(left: DataFrame, right: DataFrame, at: str, frame: str, gap: int) -> DataFrame:
    """Pairs of rows of one sample whose places lie at most gap apart: an equi-join on cells of the gap's width and the two beside."""
    size = max(1, gap)
    cell = lambda c: F.floor(F.col(c) / size)
    a = left.withColumn("__cell", F.explode(F.array(cell(at) - 1, cell(at), cell(at) + 1)))
    b = right.withColumn("__cell", cell(frame))
    return a.join(b, ["sample_id", "__cell"]).filter(F.abs(F.col(at) - F.col(frame)) <= gap).drop("__cell")


def supporting_windows(points: DataFrame, votes: DataFrame, gap: int) -> DataFrame:
    """points(sample_id, point) -> sample_id, point, windows: distinct windows that vote within gap of the point, 0 if none."""
    met = near(points, votes.select("sample_id", "frame", "window_id").distinct(), "point", "frame", gap)
    n = met.groupBy("sample_id", "point").agg(F.count_distinct("window_id").alias("windows"))
    return points.select("sample_id", "point").join(n, ["sample_id", "point"], "left").withColumn("windows", F.coalesce("windows", F.lit(0).cast("long")))


def missing(points: DataFrame, kept: DataFrame, tolerance: int) -> DataFrame:
    """points(sample_id, point) without a boundary of kept(sample_id, frame) within the tolerance."""
    found = near(points.select("sample_id", "point"), kept.select("sample_id", "frame"), "point", "frame", tolerance).select("sample_id", "point").distinct()
    return points.join(found, ["sample_id", "point"], "left_anti")


def dense_micro(voted: DataFrame, existing: DataFrame, nframes: Column, fps: float = 30.0) -> DataFrame:
    """voted(sample_id, window_id, frame) -> sample_id, point: voted frames with a neighbour of the same window within the micro
    gap, inside the video, that are no point yet."""
    w, gap = Window.partitionBy("sample_id", "window_id").orderBy("frame"), micro_gap(fps)
    back, ahead = F.col("frame") - F.lag("frame").over(w), F.lead("frame").over(w) - F.col("frame")
    close = F.coalesce((back > 0) & (back <= gap), F.lit(False)) | F.coalesce((ahead > 0) & (ahead <= gap), F.lit(False))
    rows = voted.withColumn("close", close).filter("close").filter((F.col("frame") > 0) & (F.col("frame") < nframes))
    return rows.select("sample_id", F.col("frame").alias("point")).distinct().join(existing.select("sample_id", "point"), ["sample_id", "point"], "left_anti")
