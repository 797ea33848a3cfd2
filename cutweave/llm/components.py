"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _to_least(pairs: DataFrame, least: DataFrame) -> DataFrame:
    return pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (node, root): the smallest node that each node of an edge reaches. Edges between equal nodes are ignored.

    Each round links the larger neighbours of a node to its smallest one, then the smaller ones; rounds grow with the
    logarithm of the longest path. A round's edges are written, so nothing is held by the driver or recomputed.
    """
    now = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _to_least(both.filter("v > u"), least)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _to_least(down.unionByName(down.select("u", F.col("u").alias("v"))), low)
        now = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = seen
