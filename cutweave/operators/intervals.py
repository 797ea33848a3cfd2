"""Joins of spans by what they have in common: no range filter over all rows of a sample.

Spans that begin where those before them on their side have ended are met in one window over a sample's rows in order, so that rows dealt by the
sample stay where they are. Those that overlap earlier ones of their side go by joins on equal cells.

A span lies on the level whose cells, 8^level wide, are as long as it is or longer, so it touches two cells there. Of two spans the
shorter one is looked up on the longer one's level, where it touches two cells as well. A pair is made in the first cell that both
touch, so none is made twice. How long a sample is, and how unequal its spans are, changes nothing; only levels that the other
side has are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _level(start: str, end: str) -> Column:
    length = F.greatest(F.lit(1).cast("long"), F.col(end) - F.col(start))
    return F.ceil(F.log(8.0, length.cast("double"))).cast("int")


def _dealt(df: DataFrame, level: Column, p: str) -> DataFrame:
    """A row for each cell that a span touches on a level, with the first of them."""
    cell = lambda at, by: F.floor(at / F.pow(F.lit(8.0), by)).cast("long")
    rows = df.withColumn("__level", level)
    lo, hi = cell(F.col(f"{p}start"), F.col("__level")), cell(F.greatest(F.col(f"{p}start"), F.col(f"{p}end") - 1), F.col("__level"))
    return rows.withColumn(f"{p}first", lo).withColumn("__cell", F.explode(F.sequence(lo, hi)))


def beside(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """One table of both sides' rows, each as a struct: the keys, __a of left or __b of right, the other NULL.

    Each key's rows are put together as arrays, so rows that are dealt by the keys stay where they are; a union would deal them again. Rows of
    right go where left has none of their key, with how inner the other way round too.
    """
    sides = {p: ([c for c in df.columns if c not in on], df) for p, df in (("__a", left), ("__b", right))}
    listed = {p: df.groupBy(*on).agg(F.collect_list(F.struct(*cols)).alias(p)) for p, (cols, df) in sides.items()}
    both = listed["__a"].join(listed["__b"], on, how)
    none = {p: F.lit(None).cast(both.schema[p].dataType.elementType).alias(p) for p in sides}
    rows = [F.transform(F.coalesce("__a", F.array().cast(both.schema["__a"].dataType)), lambda x: F.struct(x.alias("__a"), none["__b"])), F.transform(F.coalesce("__b", F.array().cast(both.schema["__b"].dataType)), lambda x: F.struct(none["__a"], x.alias("__b")))]
    return both.select(*on, F.inline(F.concat(*rows)))


def _marked(df: DataFrame, on: list[str], start: Column, end: Column, p: str) -> DataFrame:
    """df with its spans' bounds, and whether each begins where those before it have ended."""
    s, e = f"__{p}_start", f"__{p}_end"
    w = Window.partitionBy(*on).orderBy(s, e).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({s: start.cast("long"), e: end})
    some = F.coalesce(F.col(e) > F.col(s), F.lit(False))
    return df.withColumn(f"__{p}_apart", some & F.coalesce(F.col(s) >= F.max(F.when(some, F.col(e))).over(w), F.lit(True)))


def _by_cells(odd: DataFrame, other: DataFrame, on: list[str], p: str, q: str) -> DataFrame:
    """Pairs of marked spans (of the sides p and q) that overlap, by cells. All waits for the levels of odd, so where it has no rows, no row of other is dealt."""
    x, y = (df.filter(F.col(f"__{k}_start").isNotNull() & F.col(f"__{k}_end").isNotNull()).withColumn(f"__{k}_level", _level(f"__{k}_start", f"__{k}_end")) for df, k in ((odd, p), (other, q)))
    x_level, y_level, level = F.col(f"__{p}_level"), F.col(f"__{q}_level"), F.col("__on")
    levels = lambda df, c: F.broadcast(df.select(c.alias("__on")).distinct())  # noqa: E731  # a score of rows at most
    had = levels(x, x_level)
    x = x.join(had, x_level == level, "left_semi")
    above = y.join(had, y_level > level, "left_semi")
    keys = [*on, "__level", "__cell"]
    own_x = _dealt(x, x_level, f"__{p}_").join(_dealt(y.join(had, level >= y_level), level, f"__{q}_").drop("__on"), keys)
    own_y = _dealt(x.join(levels(above, y_level), level > x_level), level, f"__{p}_").drop("__on").join(_dealt(above, y_level, f"__{q}_"), keys)
    met = own_x.unionByName(own_y).filter((F.col("__cell") == F.greatest("__a_first", "__b_first")) & (F.col("__a_start") < F.col("__b_end")) & (F.col("__b_start") < F.col("__a_end")))
    return met.drop("__level", "__cell", *[f"__{k}_{c}" for k in "ab" for c in ("level", "first")])


def overlapping(left: DataFrame, right: DataFrame, on: list[str], spans: tuple[str, str, str, str], inclusive: bool = False, every: bool = False) -> DataFrame:
    """Pairs of rows with equal keys whose spans (start, end excluded; spans names left's and right's two columns) overlap: all
    columns of both, the keys once. With inclusive, right's end is its last place. With every, each row of left comes at least once: a
    row with NULL for all of right's columns may come alone or beside its pairs.

    Columns that both sides have, but for the keys, must be named apart before. NULL bounds overlap nothing; an empty span
    overlaps those that hold its start inside.
    """
    ls, le, rs, re = spans
    # rows without a key go at once, so that all steps read the same rows
    a = _marked(left if every else left.dropna(subset=on), on, F.col(ls), F.col(le).cast("long"), "a")
    b = _marked(right.dropna(subset=on), on, F.col(rs), F.col(re).cast("long") + int(inclusive), "b")
    out = [*on, *[c for df in (left, right) for c in df.columns if c not in on]]
    own, other = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    rows = beside(a, b, on, "left" if every else "inner").withColumns({"__at": F.coalesce("__a.__a_start", "__b.__b_start"), "__turn": own.cast("int")})
    # the later of two that overlap finds the other one as the last begun of its side; at one place right's come first
    w = Window.partitionBy(*on).orderBy("__at", "__turn").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"__last_{p}": F.last(F.when(F.col(f"__{p}.__{p}_apart"), F.col(f"__{p}")), True).over(w) for p in "ab"})
    meets_b = F.col("__a.__a_apart") & (F.col("__last_b.__b_end") > F.col("__at"))
    meets_a = F.col("__b.__b_apart") & (F.col("__last_a.__a_end") > F.col("__at"))
    x, y = F.when(own, F.col("__a")).when(meets_a, F.col("__last_a")), F.when(other, F.col("__b")).when(meets_b, F.col("__last_b"))
    rows = rows.select(*on, x.alias("x"), y.alias("y")).filter("x IS NOT NULL" if every else "x IS NOT NULL AND y IS NOT NULL")
    met = rows.select(*on, *[F.col(f"{p}.{c}").alias(c) for p, df in (("x", left), ("y", right)) for c in df.columns if c not in on])
    odd = lambda df, p: df.filter(~F.col(f"__{p}_apart"))
    rest = _by_cells(odd(a, "a"), b, on, "a", "b").unionByName(_by_cells(odd(b, "b"), a.filter("__a_apart"), on, "b", "a"))
    return met.unionByName(rest.select(*out))


def holding(points: DataFrame, spans: DataFrame, on: list[str], at: str, start: str, end: str) -> DataFrame:
    """Pairs of a point and a span (end excluded) that holds it: all columns of both, the keys once.

    Spans that begin where those before them have ended are met in one window over a sample's rows in order, so that rows dealt by
    the sample stay where they are; only spans that overlap earlier ones go by cells, on the levels that these have.
    """
    known = lambda df, *cols: df.dropna(subset=[*on, *cols])
    w = Window.partitionBy(*on).orderBy(start, end)
    ended = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = known(spans, start, end).filter(F.col(end) > F.col(start)).withColumn("__apart", F.coalesce(F.col(start) >= ended, F.lit(True)))
    pts = known(points, at)
    p_cols, s_cols = [c for c in points.columns if c not in on], [c for c in spans.columns if c not in on]
    place = lambda c: F.col(c).cast("long").alias("__at")
    begun = marked.filter("__apart").select(*on, place(start), F.lit(0).alias("__kind"), F.struct(*s_cols).alias("__s"))
    both = begun.unionByName(pts.select(*on, place(at), F.lit(1).alias("__kind"), F.struct(*p_cols).alias("__p")), True)
    met = both.withColumn("__s", F.last("__s", True).over(Window.partitionBy(*on).orderBy("__at", "__kind"))).filter((F.col("__kind") == 1) & (F.col("__at") < F.col(f"__s.{end}")))
    met = met.select(*on, *[F.col(f"__p.{c}").alias(c) for c in p_cols], *[F.col(f"__s.{c}").alias(c) for c in s_cols])
    rest = marked.filter("NOT __apart").drop("__apart").withColumns({"__b_start": F.col(start).cast("long"), "__b_end": F.col(end).cast("long")}).withColumn("__b_level", _level("__b_start", "__b_end"))
    levels = F.broadcast(rest.agg(F.collect_set("__b_level").alias("__levels")))
    asked = pts.crossJoin(levels).withColumn("__level", F.explode("__levels")).drop("__levels").withColumn("__cell", F.floor(F.col(at).cast("long") / F.pow(F.lit(8.0), F.col("__level"))).cast("long"))
    other = asked.join(_dealt(rest, F.col("__b_level"), "__b_"), [*on, "__level", "__cell"]).filter((F.col("__b_start") <= F.col(at)) & (F.col(at) < F.col("__b_end")))
    return met.unionByName(other.select(*met.columns))
