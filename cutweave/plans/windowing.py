"""Queries of the window and range generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..sources.fixtures import SAMPLES_SQL, SEGMENTS_SQL, samples, segments
from .catalog import query

FPS = "CASE WHEN coalesce(fps, 0.0) > 1e-6 THEN fps ELSE 30.0 END"


def even(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


def sampled(s: str, e: str, n: int, frames: str) -> str:
    return f"CASE WHEN {frames} > 0 THEN list_transform(range({n}), lambda i: least({frames} - 1, greatest(0, CASE WHEN i = {n - 1} AND {n} > 1 THEN {e} ELSE CAST(trunc(i * (({e} - {s}) / {max(n - 1, 1)}) + {s}) AS BIGINT) END))) ELSE [] END"


def text(column: str):
    return F.array_join(column, " ")


HOPS_SQL = f"""{SAMPLES_SQL},
plan AS (SELECT sample_id, nframes, greatest(1, {even(f"({FPS}) * 12.0")}) AS len, greatest(1, {even(f"({FPS}) * 6.0")}) AS step FROM samples WHERE nframes > 0),
hops AS (SELECT sample_id, nframes, len, unnest(range(0, nframes, step)) AS s, unnest(range(len(range(0, nframes, step)))) AS window_id FROM plan),
w AS (SELECT sample_id, nframes, window_id, s AS start_frame, least(nframes - 1, s + len - 1) AS end_incl FROM hops WHERE window_id = 0 OR least(nframes - 1, s + len - 1) - s >= len // 2)"""


@query("win01_hop_windows", f"WITH {HOPS_SQL} SELECT sample_id, window_id, start_frame, end_incl FROM w")
def win01(spark, sf_dir):
    return W.hop_windows(samples(spark, sf_dir)).drop("frame_ids")


@query("win02_even_frames", f"WITH {HOPS_SQL} SELECT sample_id, window_id, array_to_string({sampled('start_frame', 'end_incl', 24, 'nframes')}, ' ') AS frame_ids FROM w")
def win02(spark, sf_dir):
    return W.hop_windows(samples(spark, sf_dir)).select("sample_id", "window_id", text("frame_ids").alias("frame_ids"))


@query("win03_segment_frames", f"""WITH {SEGMENTS_SQL} SELECT sample_id, seg_id, array_to_string({sampled('greatest(0, start_frame)', 'greatest(greatest(0, start_frame), end_excl - 1)', 7, '4000')}, ' ') AS frame_ids FROM segments""")
def win03(spark, sf_dir):
    s = segments(spark, sf_dir)
    return s.select("sample_id", "seg_id", F.array_join(W.segment_frames(F.col("start_frame"), F.col("end_excl"), 7, F.lit(4000).cast("long")), " ").alias("frame_ids"))


@query("win04_refinement_windows", f"""WITH {HOPS_SQL},
b AS (SELECT *, greatest(1, end_incl - start_frame + 1) AS whole FROM w WHERE (sample_id + window_id) % 3 = 0),
c AS (SELECT *, least(whole, greatest({even('whole * 0.5')}, 90)) AS len FROM b), d AS (SELECT *, greatest(start_frame, end_incl - len + 1) AS last FROM c),
e AS (SELECT *, list_append(range(start_frame, last, greatest(1, len // 2)), last) AS starts FROM d),
f AS (SELECT sample_id, window_id, end_incl, nframes, len, unnest(starts) AS s, unnest(range(len(starts))) AS turn FROM e)
SELECT sample_id, 1000000 + window_id * 10 + turn AS window_id, s AS start_frame, least(end_incl, s + len - 1) AS end_incl, array_to_string({sampled('s', 'least(end_incl, s + len - 1)', 8, 'nframes')}, ' ') AS frame_ids FROM f""")
def win04(spark, sf_dir):
    s = samples(spark, sf_dir)
    w = W.hop_windows(s).filter((F.col("sample_id") + F.col("window_id")) % 3 == 0).join(s.select("sample_id", "nframes"), "sample_id")
    return W.refinement_windows(w).withColumn("frame_ids", text("frame_ids"))


@query("win05_boundary_clips", f"""WITH {SEGMENTS_SQL}, {SAMPLES_SQL},
i AS (SELECT * FROM (SELECT *, lead(seg_id) OVER (PARTITION BY sample_id ORDER BY seg_id) AS nxt FROM segments) WHERE nxt IS NOT NULL),
a AS (SELECT i.sample_id, seg_id, end_excl, nframes, greatest(1, {even(f"({FPS}) * 4.0")}) AS len FROM i JOIN samples s ON s.sample_id = i.sample_id WHERE nframes > 0),
b AS (SELECT *, least(nframes - 1, greatest(0, end_excl - len // 2) + len - 1) AS e FROM a), c AS (SELECT *, greatest(0, e - len + 1) AS s FROM b)
SELECT sample_id, seg_id AS boundary_id, end_excl AS boundary, s AS start_frame, e AS end_incl, array_to_string({sampled('s', 'e', 12, 'nframes')}, ' ') AS frame_ids FROM c""")
def win05(spark, sf_dir):
    return W.boundary_clips(segments(spark, sf_dir), samples(spark, sf_dir)).withColumn("frame_ids", text("frame_ids"))


@query("win06_chunks", f"""WITH {HOPS_SQL}, f AS (SELECT sample_id, window_id, {sampled('start_frame', 'end_incl', 10, 'nframes')} AS ids FROM w)
SELECT sample_id, window_id, CAST(c AS INT) AS chunk, array_to_string(ids[c * 4 + 1:c * 4 + 4], ' ') AS ids FROM (SELECT *, unnest(range((len(ids) + 3) // 4)) AS c FROM f)""")
def win06(spark, sf_dir):
    w = W.hop_windows(samples(spark, sf_dir), frames=10)
    return w.select("sample_id", "window_id", F.posexplode(W.chunks(F.col("frame_ids"), 4)).alias("chunk", "ids")).withColumn("ids", text("ids"))


@query("win07_probe_positions", f"""WITH n AS (SELECT o_orderkey AS id, o_orderkey % 40 AS n FROM orders)
SELECT id, CASE WHEN n > 2 THEN array_to_string(list_sort(list_distinct(list_transform([0.25::DOUBLE, 0.5, 0.75], lambda q: least(n - 2, greatest(1, {even('(n - 1) * q')}))))), ' ') ELSE '' END AS places FROM n""")
def win07(spark, sf_dir):
    from ..sources.fixtures import table

    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(W.probe_positions(F.col("o_orderkey") % 40), " ").alias("places"))


@query("win08_middle_positions", """WITH n AS (SELECT o_orderkey AS id, o_orderkey % 40 AS n FROM orders)
SELECT id, CASE WHEN n > 2 THEN array_to_string(list_sort(list_distinct(list_filter([greatest(1, n // 2 - 2), greatest(1, n // 2 - 1), least(n - 2, n // 2), least(n - 2, n // 2 + 1)], lambda i: i > 0 AND i < n - 1))), ' ') ELSE '' END AS places FROM n""")
def win08(spark, sf_dir):
    from ..sources.fixtures import table

    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(W.middle_positions(F.col("o_orderkey") % 40), " ").alias("places"))


@query("win09_centre_weights", "SELECT o_orderkey AS id, round(0.5 - 0.5 * cos(2 * pi() * (o_orderkey % 24 + 1) / 25), 9) AS weight FROM orders")
def win09(spark, sf_dir):
    from ..sources.fixtures import table

    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.round(W.centre_weight(F.col("o_orderkey") % 24, F.lit(24)), 9).alias("weight"))


@query("win10_prompt_facts", f"WITH {HOPS_SQL} SELECT w.sample_id, window_id, start_frame, end_incl, {FPS} AS fps, greatest(0, s.nframes) AS nframes FROM w JOIN samples s ON s.sample_id = w.sample_id")
def win10(spark, sf_dir):
    s = samples(spark, sf_dir)
    facts = s.select("sample_id", W.safe_fps(F.col("fps")).alias("fps"), F.greatest(F.lit(0).cast("long"), F.col("nframes")).alias("nframes"))
    return W.hop_windows(s).drop("frame_ids").join(facts, "sample_id")


@query("win11_bins", f"""WITH {SEGMENTS_SQL}, f AS (SELECT sample_id, seg_id, start_frame, unnest(range(start_frame, end_excl, 17)) AS frame FROM segments)
SELECT sample_id, seg_id, (frame - start_frame) // 60 AS bin, count(*) AS frames FROM f GROUP BY ALL""")
def win11(spark, sf_dir):
    return W.frames_by_bin(segments(spark, sf_dir), 17, F.lit(30.0))
