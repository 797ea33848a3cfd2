"""Window and range generators: planned windows, sampled frames, clips around boundaries, chunks and bins.

Frames count from 0. Window ends are inclusive, segment ends exclusive. Rounding is half to even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def even(x: Column) -> Column:
    """x rounded half to even, as a long."""
    return F.bround(x).cast("long")


def safe_fps(fps: Column) -> Column:
    return F.when(F.coalesce(fps, F.lit(0.0)) > 1e-6, fps).otherwise(F.lit(30.0))


def stride(start: Column, end: Column, count: int) -> Column:
    """The distance of count places that lie evenly from start to end."""
    return (end - start) / F.lit(max(count - 1, 1))


def spaced(start: Column, end: Column, count: int, step: Column) -> list[Column]:
    """count places from start to end, step apart, cut to whole frames; none lies outside. An expression for each, since these compile
    and a lambda doesn't; step as a column of its own is computed once, and keeps the generated method below what the JVM compiles."""
    return [end if i == count - 1 and count > 1 else (F.lit(float(i)) * step + start).cast("long") for i in range(count)]


def sampled(start: Column, end: Column, count: int, nframes: Column) -> Column:
    """count frames at even distances from start to end, cut to whole frames and kept inside the video; none of an empty video."""
    if count <= 0:
        return F.array().cast("array<bigint>")
    kept = [F.least(nframes - 1, F.greatest(F.lit(0).cast("long"), x)) for x in spaced(start, end, count, stride(start, end, count))]
    return F.when(nframes > 0, F.array(*kept)).otherwise(F.array().cast("array<bigint>"))


def hop_windows(samples: DataFrame, window_sec: float = 12.0, step_sec: float = 6.0, frames: int = 24) -> DataFrame:
    """samples(sample_id, fps, nframes) -> sample_id, window_id, start_frame, end_incl, frame_ids.

    A window that reaches less than half its length ends the plan, but for the first. Lengths fall as starts rise once the end
    of the video is reached, so that rule is a filter on each start by itself.
    """
    fps = safe_fps(F.col("fps"))
    length, step = F.greatest(F.lit(1), even(fps * window_sec)), F.greatest(F.lit(1), even(fps * step_sec))
    # a sample gives many rows and a file holds many samples, so these are dealt to all tasks first
    tasks = max(int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions")), samples.sparkSession.sparkContext.defaultParallelism)
    rows = samples.filter("nframes > 0").select("sample_id", "nframes", length.alias("length"), step.alias("step")).repartition(tasks, "sample_id")
    rows = rows.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("nframes") - 1, F.col("step"))).alias("window_id", "start_frame"))
    rows = rows.withColumn("end_incl", F.least(F.col("nframes") - 1, F.col("start_frame") + F.col("length") - 1))
    rows = rows.filter((F.col("window_id") == 0) | (F.col("end_incl") - F.col("start_frame") >= F.floor(F.col("length") / 2)))
    # both ends lie inside the video, so all places do
    ids = F.array(*spaced(F.col("start_frame"), F.col("end_incl"), frames, F.col("stride"))).cast("array<bigint>").alias("frame_ids")
    rows = rows.withColumn("stride", stride(F.col("start_frame"), F.col("end_incl"), frames))
    return rows.select("sample_id", F.col("window_id").cast("long").alias("window_id"), "start_frame", "end_incl", ids)


def segment_frames(start: Column, end_excl: Column, count: int, nframes: Column) -> Column:
    """Frames of a segment: its exclusive end is the frame after its last."""
    first = F.greatest(F.lit(0).cast("long"), start)
    last = F.greatest(first, end_excl - 1)
    return sampled(first, last, count, nframes)


def refinement_windows(windows: DataFrame, fps: float = 30.0, frames: int = 8, base: int = 1_000_000) -> DataFrame:
    """windows(sample_id, window_id, start_frame, end_incl, nframes) -> shorter windows inside each, half as long, at half steps;
    the last one ends where the window does."""
    whole = F.greatest(F.lit(1).cast("long"), F.col("end_incl") - F.col("start_frame") + 1)
    length = F.least(whole, F.greatest(even(whole * 0.5), F.lit(round(3.0 * fps))))
    last = F.greatest(F.col("start_frame"), F.col("end_incl") - length + 1)
    starts = F.array_distinct(F.concat(F.filter(F.sequence(F.col("start_frame"), last, F.greatest(F.lit(1).cast("long"), F.floor(length / 2))), lambda s: s < last), F.array(last)))
    rows = windows.select("sample_id", F.col("window_id").alias("parent"), "end_incl", "nframes", length.alias("length"), F.posexplode(starts).alias("turn", "start"))
    end = F.least(F.col("end_incl"), F.col("start") + F.col("length") - 1)
    return rows.select("sample_id", (F.lit(base) + F.col("parent") * 10 + F.col("turn")).alias("window_id"), F.col("start").alias("start_frame"), end.alias("end_incl"), sampled(F.col("start"), end, frames, F.col("nframes")).alias("frame_ids"))


def boundary_clips(segments: DataFrame, samples: DataFrame, window_sec: float = 4.0, frames: int = 12) -> DataFrame:
    """A clip around each inner boundary, shifted back inside the video: sample_id, boundary_id, boundary, start_frame, end_incl, frame_ids."""
    inner = segments.withColumn("next", F.lead("seg_id").over(Window.partitionBy("sample_id").orderBy("seg_id"))).filter("next IS NOT NULL")
    rows = inner.join(samples, "sample_id").filter("nframes > 0").withColumn("length", F.greatest(F.lit(1), even(safe_fps(F.col("fps")) * window_sec)))
    first = F.greatest(F.lit(0).cast("long"), F.col("end_excl") - F.floor(F.col("length") / 2))
    rows = rows.withColumn("end_incl", F.least(F.col("nframes") - 1, first + F.col("length") - 1)).withColumn("start", F.greatest(F.lit(0).cast("long"), F.col("end_incl") - F.col("length") + 1))
    return rows.select("sample_id", F.col("seg_id").alias("boundary_id"), F.col("end_excl").alias("boundary"), F.col("start").alias("start_frame"), "end_incl", sampled(F.col("start"), F.col("end_incl"), frames, F.col("nframes")).alias("frame_ids"))


def chunks(ids: Column, size: int) -> Column:
    """Consecutive parts of an array, each of size elements but the last."""
    size = max(1, size)
    return F.when(F.size(ids) > 0, F.transform(F.sequence(F.lit(1), F.size(ids), F.lit(size)), lambda i: F.slice(ids, i, size))).otherwise(F.array())


def probe_positions(n: Column) -> Column:
    """The quarter positions of n frames, inside 1 to n - 2; none for two frames or fewer."""
    at = [F.least(n - 2, F.greatest(F.lit(1).cast("long"), even((n - 1) * q))) for q in (0.25, 0.5, 0.75)]
    return F.when(n > 2, F.array_sort(F.array_distinct(F.array(*at)))).otherwise(F.array().cast("array<bigint>"))


def middle_positions(n: Column) -> Column:
    """The four middle positions of n frames that lie strictly inside."""
    half, one = F.floor(n / 2), F.lit(1).cast("long")
    four = F.array(F.greatest(one, half - 2), F.greatest(one, half - 1), F.least(n - 2, half), F.least(n - 2, half + 1))
    return F.when(n > 2, F.array_sort(F.array_distinct(F.filter(four, lambda i: (i > 0) & (i < n - 1))))).otherwise(F.array().cast("array<bigint>"))


def centre_weight(k: Column, n: Column) -> Column:
    """Weight of place k of n: a raised cosine that is largest in the middle and nowhere 0."""
    return 0.5 - 0.5 * F.cos(2 * F.pi() * (k + 1) / (n + 1))


def bin_size(fps: Column, bin_sec: float = 2.0) -> Column:
    """Frames of a bin."""
    return F.greatest(F.lit(1), even(F.lit(max(0.5, bin_sec)) * F.greatest(fps, F.lit(1.0))))


def bin_of(frame: Column, start: Column, fps: Column, bin_sec: float = 2.0) -> Column:
    """Number of the bin of a frame within its segment."""
    return F.floor((frame - start) / bin_size(fps, bin_sec)).cast("long")


def frames_by_bin(segments: DataFrame, every: int, fps: Column, bin_sec: float = 2.0) -> DataFrame:
    """segments(sample_id, seg_id, start_frame, end_excl) -> sample_id, seg_id, bin, frames: how many of each segment's frames, every so
    many from its start, lie in each bin that holds any. Frames are counted from the bounds, so none is made and nothing is grouped."""
    length, size = F.col("end_excl") - F.col("start_frame"), bin_size(fps, bin_sec)
    upto = lambda x: F.ceil(x / every)  # frames before an offset
    last = F.col("start_frame") + (upto(length) - 1) * every
    rows = segments.filter("end_excl > start_frame").select("sample_id", "seg_id", length.alias("length"), F.explode(F.sequence(F.lit(0).cast("long"), bin_of(last, F.col("start_frame"), fps, bin_sec))).alias("bin"))
    frames = upto(F.least("length", (F.col("bin") + 1) * size)) - upto(F.col("bin") * size)
    return rows.select("sample_id", "seg_id", "bin", frames.cast("long").alias("frames")).filter("frames > 0")
