"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Main path: DataFrame operations only. What the driver sees are two sums for each round of the filling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, global_rank, written

#: Hex digits of the seeded hash that split each source into buckets of a running sum: 4,096 of them, so that a source with
#: a third of all rows is spread over as many groups.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fill(sources: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """sources(source, source_size) -> source_no, source, source_size, target.

    Sources are numbered by code point, NULL last, and take the weights in turn. Those whose part of the total lies above
    max_epochs times their size are clamped there; the rest is reshared by weight until no source is above its cap.
    Targets are 0 where a source is empty.
    """
    ranked = global_rank(sources, [F.col("source").asc_nulls_last()], "source_no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    sized = written(ranked.select("source_no", "source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")), "sources")
    want = float(sized.agg(F.sum("source_size")).first()[0] or 0) * share
    level = (0.0, 1.0)
    while True:  # the clamped only ever grow, and a round that clamps none ends the loop
        rest, over = level
        clamped = F.col("cap") <= F.lit(rest) * F.col("w") / F.lit(over)
        kept = sized.agg(F.sum(F.when(clamped, F.col("cap")).otherwise(0.0)), F.sum(F.when(clamped, 0.0).otherwise(F.col("w")))).first()
        nxt = (want - (kept[0] or 0.0), kept[1] or 0.0)
        if nxt[1] == 0.0 or nxt == level:
            break
        level = nxt
    rest, over = level
    part = F.lit(rest) * F.col("w") / F.lit(over)
    return written(sized.select("source_no", "source", "source_size", F.when(F.col("cap") <= part, F.col("cap")).otherwise(part).alias("target")), "targets")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix-1", carry: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target, times, taken; with carry also row, the whole input row.

    Every row is taken floor(target / source_size) times. For the fraction that remains, the rows of a source stand in the
    order of md5(seed:id:text), and the leading ones are taken once more, as many as come nearest to the target: the error is at
    most half a document. NULL texts have size 0; a NULL source is a source of its own, numbered last; repeated rows count
    each; a NULL id is hashed as the word null, with the text as all are; an empty table gives an empty result. The result depends on the rows and the seed only.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))))
    cols = [F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("size"), F.col(source_col).alias("source"), key.alias("key")]
    rows = docs.select(*cols, *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    rows = written(rows, "mix-rows")
    targets = fill(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    known = rows.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("source_no", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = known.groupBy("source_no", "bucket").agg(F.sum("size").alias("bucket_size"))
    ahead = F.sum("bucket_size").over(Window.partitionBy("source_no").orderBy("bucket")) - F.col("bucket_size")
    placed = known.withColumn("inside", inside).join(sums.select("source_no", "bucket", ahead.alias("ahead")), ["source_no", "bucket"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    extra = (2 * (F.col("ahead") + F.col("inside")) + F.col("size")) <= 2 * rest
    times = whole + F.when(extra & (whole < max_epochs), 1).otherwise(0)
    out = placed.withColumn("times", times).withColumn("taken", F.col("times") * F.col("size"))
    return out.select("doc_id", "size", "source_size", "target", "times", "taken", *(["row"] if carry else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, with docs' own columns."""
    taken = mix(docs, carry=True, **options)
    return taken.select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS key,
             CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, CASE no % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, no) AS k,
        coalesce(sum(cap) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
        sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above,
        (SELECT sum(source_size) FROM w) * 1.5::DOUBLE AS want FROM w),
f AS (SELECT want - below AS rest, above FROM o WHERE (want - below) * w / above <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT rest FROM f) * w / (SELECT above FROM f), cap)) AS target FROM o),
c AS (SELECT d.*, t.source_size, t.target,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN 2 * ahead + size <= 2 * (target - whole * source_size) AND whole < 2 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
"""
