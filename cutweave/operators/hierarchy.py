"""Nested hierarchies from partitions of several levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def enclosed(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """inner(sample_id, start_idx, end_idx, ...) with parent, the start of the range of outer that holds it; ranges that none holds
    whole go. Outer ranges of a sample lie apart; both are swept once in the order of their starts."""
    rows = inner.withColumn("__end", F.lit(None).cast("long")).unionByName(outer.select("sample_id", "start_idx", F.col("end_idx").alias("__end")), allowMissingColumns=True)
    w = Window.partitionBy("sample_id").orderBy("start_idx", F.col("__end").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_ = F.last(F.when(F.col("__end").isNotNull(), F.struct("start_idx", "__end")), True).over(w)
    return rows.withColumn("__open", open_).filter(F.col("__end").isNull() & (F.col("end_idx") <= F.col("__open.__end"))).select(*inner.columns, F.col("__open.start_idx").alias("parent"))


FIELDS = ["level", "summary", "start_seg_id", "end_seg_id", "start_frame", "end_frame"]


def _gathered(rows: DataFrame, k: int, deepest: bool) -> DataFrame:
    """The ranges of level k as children, in order, of those above that hold them; all others stay by themselves."""
    held = F.col("depth") == k
    key = [F.when(held, k - 1).otherwise(F.col("depth")).alias("depth"), F.when(held, F.col("parent")).otherwise(F.col("start_idx")).alias("at")]
    child = F.when(held, F.struct("start_idx", whole(deepest).alias("node"))).alias("child")
    keyed = rows.filter(~held | F.col("parent").isNotNull()).select("sample_id", *key, F.when(~held, F.struct("parent", "node")).alias("own"), child)
    out = keyed.groupBy("sample_id", "depth", F.col("at").alias("start_idx")).agg(F.first("own", True).alias("own"), F.collect_list("child").alias("held")).filter("own IS NOT NULL")
    return out.select("sample_id", "depth", "start_idx", "own.parent", "own.node", F.sort_array("held")["node"].alias("children"))


def whole(deepest: bool) -> Column:
    return F.col("node") if deepest else F.struct(*[F.col(f"node.{f}").alias(f) for f in FIELDS], "children")


def nested(ranges: DataFrame, segments: DataFrame, levels: list[str]) -> DataFrame:
    """ranges(sample_id, level, start_idx, end_idx, summary), segments(sample_id, seg_id from 0, start_frame, end_excl) -> sample_id,
    roots: the ranges of the first level, in order, each with level, summary, start_seg_id, end_seg_id, start_frame, end_frame and
    children, the ranges of the next level that it holds, to the last level, whose ranges have none.

    levels go from coarse to fine and may be any number. Ranges of one level lie apart; those that no range of the level above
    holds whole, and those that end outside the segments, are left out, and so are samples without a root. Spaces around summaries
    go; NULL ones are empty.
    """
    listed = segments.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("seg_id", "start_frame", "end_excl"))).alias("segs"))

    def at(idx: str) -> Column:
        # ids count from 0, so a segment lies at its own place; looked for only where ids have gaps
        own = F.get("segs", F.col(idx).cast("int"))
        return F.when(own["seg_id"] == F.col(idx), own).otherwise(F.get(F.filter("segs", lambda x: x["seg_id"] == F.col(idx)), F.lit(0)))

    # joins by sample alone and one table of all levels: rows stay where they were dealt
    depth = F.array_position(F.array(*[F.lit(k) for k in levels]), F.col("level")).cast("int") - 1
    nodes = ranges.select("sample_id", depth.alias("depth"), "level", "start_idx", "end_idx", F.coalesce(F.trim("summary"), F.lit("")).alias("summary")).filter("depth >= 0").join(listed, "sample_id")
    nodes = nodes.select("sample_id", "depth", "level", "summary", "start_idx", "end_idx", at("start_idx")["start_frame"].alias("start_frame"), at("end_idx")["end_excl"].alias("end_frame"), at("start_idx").isNotNull().alias("starts"), at("end_idx").isNotNull().alias("stops"))
    nodes = nodes.filter("starts AND stops").drop("starts", "stops")
    w = Window.partitionBy("sample_id").orderBy("start_idx", "depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = F.lit(None).cast("struct<start_idx:bigint,end_idx:bigint>")
    for k in range(1, len(levels)):
        above = F.when(F.col("depth") == k, F.last(F.when(F.col("depth") == k - 1, F.struct("start_idx", "end_idx")), True).over(w)).otherwise(above)
    nodes = nodes.withColumn("above", above)
    rows = nodes.select("sample_id", "depth", "start_idx", F.when(F.col("end_idx") <= F.col("above.end_idx"), F.col("above.start_idx")).alias("parent"), F.struct("level", "summary", F.col("start_idx").alias("start_seg_id"), F.col("end_idx").alias("end_seg_id"), "start_frame", "end_frame").alias("node"))
    for k in range(len(levels) - 1, 0, -1):
        rows = _gathered(rows, k, k == len(levels) - 1)
    found = F.sort_array(F.collect_list(F.struct("start_idx", whole(len(levels) == 1).alias("node"))))
    return rows.groupBy("sample_id").agg(found["node"].alias("roots"))
