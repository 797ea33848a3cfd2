"""Running sums and maxima over a whole table in one order, without ever putting all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import settled


def running(df: DataFrame, order: list[str], totals: dict[str, tuple[str, Column]], before: bool = False) -> DataFrame:
    """df with each total (sum or max of a column) over the rows up to this one, or with before up to the one before it.

    Rows are dealt by ranges of the order, so equal rows share a range; each range adds the totals of the ranges before it, of which there is
    one row a range. The order should tell rows apart: of equal rows any may come first.
    """
    ranged = settled(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    kinds = {"sum": F.sum, "max": F.max}
    whole = ranged.groupBy("__range").agg(*[kinds[kind](value).alias(name) for name, (kind, value) in totals.items()])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = whole.select("__range", *[kinds[kind](name).over(earlier).alias(f"__{name}") for name, (kind, _) in totals.items()])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    local = ranged.select("*", *[kinds[kind](value).over(inside).alias(name) for name, (kind, value) in totals.items()]).join(carried, "__range")
    join = {"sum": lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)), "max": F.greatest}  # greatest leaves NULL out
    return local.withColumns({name: join[kind](F.col(name), F.col(f"__{name}")) for name, (kind, _) in totals.items()}).drop("__range", *[f"__{name}" for name in totals])


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with each row's place (from 1) in one order over all rows."""
    return running(df, order, {name: ("sum", F.lit(1).cast("long"))})
