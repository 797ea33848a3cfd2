"""Engine tables as projections of the given tables, as DataFrames and as the same projections in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, fps (a quarter of them unusable), nframes."""
    o = table(spark, sf_dir, "orders")
    fps = F.element_at(F.array(F.lit(30.0), F.lit(25.0), F.lit(29.97), F.lit(0.0)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("sample_id"), fps.alias("fps"), (F.floor("o_totalprice") % 5000).cast("long").alias("nframes"))


SAMPLES_SQL = """samples AS (SELECT o_orderkey AS sample_id, [30.0::DOUBLE, 25.0, 29.97, 0.0][CAST(o_orderkey % 4 + 1 AS INT)] AS fps,
  CAST(floor(o_totalprice) AS BIGINT) % 5000 AS nframes FROM orders)"""

VERBS = {"RO": "Pick up the", "RF": "Stir the", "AF": "Add the", "AO": "Chop the", "NO": "Place the", "NF": "Prepare the"}
FOODS = ["onion", "tomatoes", "green onion", "salt", "mixture", "ingredients", "potatoes", "bowl"]
PLACES = {"ECONOMY": "to the pot", "SMALL": "into the bowl", "MEDIUM": "in the pan", "PROMO": "", "STANDARD": "on the tray", "LARGE": "to the pot first"}


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, seg_id, start_frame, end_excl, instruction, confidence, support_before, support_after, part (30 frames a second).

    Segments of a sample follow each other without gaps. A missing support is NULL.
    """
    # named before rows are dealt, so that steps by sample_id find them dealt by it
    li, part = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "sample_id"), table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    w = Window.partitionBy("sample_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    verb = F.create_map(*[F.lit(x) for kv in VERBS.items() for x in kv])[F.concat("l_returnflag", "l_linestatus")]
    food = F.element_at(F.array(*[F.lit(f) for f in FOODS]), (F.col("l_partkey") % len(FOODS) + 1).cast("int"))
    place = F.create_map(*[F.lit(x) for kv in PLACES.items() for x in kv])[F.col("p_type")]
    dur, end = F.floor(F.col("l_quantity") * 30).cast("long"), F.sum(F.floor(F.col("l_quantity") * 30).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    support = F.when(F.col("l_suppkey") % 5 != 0, F.col("l_discount") * 10 + F.lit(0.0))
    rows = li.join(part, li.l_partkey == part.p_partkey).withColumn("after", support)
    return rows.select(
        "sample_id", (F.row_number().over(w) - 1).cast("long").alias("seg_id"), (end - dur).alias("start_frame"), end.alias("end_excl"),
        F.trim(F.concat_ws(" ", verb, F.col("p_name"), food, place)).alias("instruction"), (1 - F.col("l_tax")).alias("confidence"), F.lag("after").over(w).alias("support_before"), F.col("after").alias("support_after"), F.col("l_partkey").alias("part"),
    )


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


SEGMENTS_SQL = f"""segments AS (SELECT sample_id, seg_id, end_excl - dur AS start_frame, end_excl, instruction, confidence,
    lag(after) OVER (PARTITION BY sample_id ORDER BY seg_id) AS support_before, after AS support_after, part
  FROM (SELECT l_orderkey AS sample_id, CAST(row_number() OVER w - 1 AS BIGINT) AS seg_id, CAST(floor(l_quantity * 30) AS BIGINT) AS dur,
    CAST(sum(CAST(floor(l_quantity * 30) AS BIGINT)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_excl,
    trim(concat_ws(' ', {_case("l_returnflag || l_linestatus", VERBS)}, p_name, {FOODS}[CAST(l_partkey % {len(FOODS)} + 1 AS INT)], {_case("p_type", PLACES)})) AS instruction,
    1 - l_tax AS confidence, CASE WHEN l_suppkey % 5 <> 0 THEN l_discount * 10 + 0.0 END AS after, l_partkey AS part
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate)))"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, frame, window_id, repeat_index, weight, event_id: cut votes, 64 a sample."""
    e = table(spark, sf_dir, "events")
    frame = (F.col("event_id") * 7919 + F.floor("value").cast("long") * 2) % 997
    return e.select(F.floor(F.col("event_id") / 64).cast("long").alias("sample_id"), frame.alias("frame"), F.floor(frame / 100).cast("long").alias("window_id"), (F.col("event_id") % 3).alias("repeat_index"), F.floor(F.col("value") * 4).cast("double").alias("weight"), "event_id")


VOTES_SQL = """votes AS (SELECT sample_id, frame, frame // 100 AS window_id, repeat_index, weight, event_id FROM (SELECT event_id // 64 AS sample_id,
  (event_id * 7919 + CAST(floor(value) AS BIGINT) * 2) % 997 AS frame, event_id % 3 AS repeat_index, CAST(floor(value * 4) AS DOUBLE) AS weight, event_id FROM events))"""
