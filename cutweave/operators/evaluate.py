"""Boundary recall: one-to-one matches of true and predicted boundaries within a tolerance, and their summary."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EVENT = "sample_id {id}, frame long, idx {idx}, mate long"


def greedy_matches(events: DataFrame, tolerance: int) -> DataFrame:
    """events(sample_id, turn, frame, idx) -> sample_id, frame, idx, mate: the largest one-to-one matching within a tolerance.

    idx is NULL for predictions; turn is the frame, less the tolerance for true boundaries. Each prediction, in ascending order, goes to the
    first true boundary that still waits and is not too far behind. Rows are sorted by sample and turn within partitions and read once,
    with the boundaries within the tolerance at a time, so the work is linear in a sample's rows and no sample has to fit in memory.
    """
    schema = EVENT.format(id=events.schema["sample_id"].dataType.simpleString(), idx=events.schema["idx"].dataType.simpleString())

    def run(batches):
        import pyarrow as pa

        sample, waits = None, deque()
        types, out = None, []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["sample_id", "frame", "idx", "mate"])
            out.clear()
            return made

        for rows in batches:
            types = [rows.schema.field("sample_id").type, pa.int64(), rows.schema.field("idx").type, pa.int64()]
            for at, frame, idx, true in zip(*(rows.column(c).to_pylist() for c in ("sample_id", "frame", "idx", "true")), strict=True):
                if at != sample:
                    out.extend((sample, *w, None) for w in waits)
                    sample = at
                    waits.clear()
                if true:
                    waits.append((frame, idx))
                    continue
                while waits and waits[0][0] + tolerance < frame:
                    out.append((sample, *waits.popleft(), None))
                if waits:
                    out.append((sample, *waits.popleft(), frame))
                else:
                    out.append((sample, frame, None, frame))
            yield batch()
        if waits:
            out.extend((sample, *w, None) for w in waits)
            yield batch()

    # a hash of the sample, not the sample: over a union of two sides that are dealt by samples already, Spark leaves that step out, and
    # where it then joins small partitions of one side alone, a sample's sides lie apart
    ordered = events.repartition(F.xxhash64("sample_id")).sortWithinPartitions("sample_id", "turn", F.desc("true"), "frame", "idx")
    return ordered.select("sample_id", "frame", "idx", "true").mapInArrow(run, schema)


def matches(truth: DataFrame, predicted: DataFrame, tolerance: int = 5) -> DataFrame:
    """truth(sample_id, idx, frame), predicted(sample_id, frame) -> sample_id, idx, frame, pred_frame, delta, hit.

    A boundary without a match names the nearest prediction that no other took, the earlier one of two; NULL where none is left.
    Samples without true boundaries give no rows; boundaries and predictions without a frame count as none.
    """
    g = truth.filter("frame IS NOT NULL").select("sample_id", (F.col("frame") - tolerance).cast("long").alias("turn"), F.col("frame").cast("long").alias("frame"), "idx", F.lit(True).alias("true"))
    p = predicted.filter("frame IS NOT NULL").select("sample_id", F.col("frame").cast("long").alias("turn"), F.col("frame").cast("long").alias("frame"), F.lit(None).cast(truth.schema["idx"].dataType).alias("idx"), F.lit(False).alias("true"))
    found = greedy_matches(g.unionByName(p), tolerance)
    # what is left over: predictions that are their own mate
    free = F.when(F.col("idx").isNull(), F.col("frame"))
    w = Window.partitionBy("sample_id").orderBy("frame")
    sides = found.withColumns({"back": F.last(free, True).over(w), "ahead": F.first(free, True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))}).filter("idx IS NOT NULL")
    near = F.when(F.col("ahead") - F.col("frame") < F.coalesce(F.col("frame") - F.col("back"), F.lit(1 << 62)), F.col("ahead")).otherwise(F.coalesce("back", "ahead"))
    out = sides.select("sample_id", "idx", "frame", F.col("mate").isNotNull().alias("hit"), F.coalesce("mate", near).alias("pred_frame"))
    return out.withColumn("delta", F.col("pred_frame") - F.col("frame"))


def recall(truth: DataFrame, predicted: DataFrame, tolerance: int = 5) -> DataFrame:
    """For each sample with true or predicted boundaries: counts, recall (0 without true ones) and the hits' distances (NULL without hits)."""
    found = matches(truth, predicted, tolerance)
    d = F.when(F.col("hit"), F.abs("delta"))
    scored = found.groupBy("sample_id").agg(F.count("*").alias("gt_count"), F.count_if("hit").alias("hit_count"), F.avg(d).alias("mean_delta"), F.median(d).alias("median_delta"), F.max(d).alias("max_delta"))
    both = scored.join(predicted.groupBy("sample_id").agg(F.count("*").alias("pred_count")), "sample_id", "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    rate = F.when(F.coalesce("gt_count", F.lit(0)) > 0, F.col("hit_count") / F.col("gt_count")).otherwise(F.lit(0.0))
    return both.select("sample_id", zero("gt_count"), zero("pred_count"), zero("hit_count"), (F.coalesce("gt_count", F.lit(0)) - F.coalesce("hit_count", F.lit(0))).cast("long").alias("miss_count"), rate.alias("recall"), "mean_delta", "median_delta", "max_delta")
