"""Queries of cut votes, sessions and cut points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import segments as S
from ..operators import votes as V
from ..sources.fixtures import VOTES_SQL, votes
from .catalog import query

FPS, GAP, MICRO, END = 30.0, V.peak_gap(30.0), V.micro_gap(30.0), 950


def islands_sql(source: str, keys: str, order: str, gap: int) -> str:
    return f"""(SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY {order}) AS island FROM
      (SELECT *, CASE WHEN {order} - lag({order}) OVER (PARTITION BY {keys} ORDER BY {order}) > {gap} THEN 1 ELSE 0 END AS new FROM {source}))"""


CLUSTERS_SQL = f"""{VOTES_SQL}, each AS (SELECT sample_id, frame, count(*) AS n, sum(weight) AS support FROM votes GROUP BY ALL),
runs AS (SELECT *, row_number() OVER (PARTITION BY sample_id, island ORDER BY n DESC, support DESC, frame) AS pick, sum(support) OVER (PARTITION BY sample_id, island) AS total FROM {islands_sql('each', 'sample_id', 'frame', GAP)}),
points AS (SELECT sample_id, frame AS point, total AS support FROM runs WHERE pick = 1)"""
REPEATS_SQL = f"""{VOTES_SQL}, t AS (SELECT sample_id, window_id, greatest(count(DISTINCT repeat_index), (sample_id + window_id) % 3 + 1) AS total FROM votes GROUP BY sample_id, window_id),
f AS (SELECT sample_id, window_id, frame, list(DISTINCT repeat_index) AS reps, count(*) AS n FROM votes GROUP BY ALL),
fi AS (SELECT * FROM {islands_sql('(SELECT f.*, total FROM f JOIN t USING (sample_id, window_id) WHERE total > 1)', 'sample_id, window_id', 'frame', GAP)}),
fr AS (SELECT *, row_number() OVER (PARTITION BY sample_id, window_id, island ORDER BY len(reps) DESC, n DESC, frame) AS pick FROM fi),
fs AS (SELECT sample_id, window_id, island, count(DISTINCT rep) AS k FROM (SELECT *, unnest(reps) AS rep FROM fi) GROUP BY ALL),
voted AS (SELECT sample_id, window_id, frame, k / total AS support FROM fr JOIN fs USING (sample_id, window_id, island) WHERE pick = 1
  UNION ALL SELECT sample_id, window_id, frame, 1.0 FROM f JOIN t USING (sample_id, window_id) WHERE total = 1)"""


def repeats(v):
    """Usable repeats of each window: up to two of them saw no cut."""
    planned = (F.col("sample_id") + F.col("window_id")) % 3 + 1
    return v.groupBy("sample_id", "window_id").agg(F.count_distinct("repeat_index").alias("n")).select("sample_id", "window_id", F.greatest("n", planned).alias("total"))


def voted(v):
    return V.repeat_votes(v, repeats(v), FPS)


@query("agg02_repeat_vote", f"WITH {REPEATS_SQL} SELECT * FROM voted")
def agg02(spark, sf_dir):
    return voted(votes(spark, sf_dir))


@query("sel03_text_sources", f"""WITH {REPEATS_SQL}, rec AS (SELECT sample_id, window_id, repeat_index, list(DISTINCT frame) AS frames, count(*) + 1 AS texts FROM votes GROUP BY sample_id, window_id, repeat_index),
vv AS (SELECT sample_id, window_id, list(frame) AS cuts FROM voted GROUP BY sample_id, window_id),
sc AS (SELECT rec.*, cuts, list_transform(cuts, lambda v: list_min(list_transform(frames, lambda f: abs(f - v)))) AS far FROM rec LEFT JOIN vv USING (sample_id, window_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY sample_id, window_id ORDER BY len(list_filter(far, lambda d: d <= {GAP})) DESC, list_sum(far), abs(len(frames) - len(cuts)), texts DESC, repeat_index) AS k FROM sc)
SELECT sample_id, window_id, repeat_index FROM k WHERE k = 1""")
def sel03(spark, sf_dir):
    v = votes(spark, sf_dir)
    records = v.groupBy("sample_id", "window_id", "repeat_index").agg(F.collect_set("frame").alias("frames"), (F.count("*") + 1).alias("texts"))
    return V.text_sources(records, voted(v), FPS)


@query("agg03_accumulated_votes", f"WITH {VOTES_SQL} SELECT sample_id, frame, count(*) AS n, sum(weight) AS support, count(DISTINCT window_id) AS windows FROM votes GROUP BY ALL")
def agg03(spark, sf_dir):
    return V.accumulated(votes(spark, sf_dir))


@query("agg04_cut_clusters", f"WITH {CLUSTERS_SQL} SELECT * FROM points")
def agg04(spark, sf_dir):
    return V.clusters(votes(spark, sf_dir), FPS)


@query("ses01_islands", f"WITH {VOTES_SQL}, d AS (SELECT DISTINCT sample_id, frame FROM votes) SELECT sample_id, island, min(frame) AS first, max(frame) AS last, count(*) AS n FROM {islands_sql('d', 'sample_id', 'frame', 9)} GROUP BY ALL")
def ses01(spark, sf_dir):
    d = votes(spark, sf_dir).select("sample_id", "frame").distinct()
    return V.islands(d, ["sample_id"], "frame", 9).groupBy("sample_id", "island").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.count("*").alias("n"))


@query("ses02_probe_merge", f"WITH {CLUSTERS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY sample_id, island ORDER BY support DESC, point) AS pick FROM {islands_sql('points', 'sample_id', 'point', 30)}) SELECT sample_id, point, support FROM r WHERE pick = 1")
def ses02(spark, sf_dir):
    return V.merged_points(V.clusters(votes(spark, sf_dir), FPS), 30)


@query("ses03_micro_boundaries", f"""WITH {REPEATS_SQL}, {CLUSTERS_SQL.removeprefix(VOTES_SQL + ', ')},
g AS (SELECT *, frame - lag(frame) OVER w AS back, lead(frame) OVER w - frame AS ahead FROM voted WINDOW w AS (PARTITION BY sample_id, window_id ORDER BY frame))
SELECT DISTINCT sample_id, frame AS point FROM g WHERE (back BETWEEN 1 AND {MICRO} OR ahead BETWEEN 1 AND {MICRO}) AND frame > 0 AND frame < {END}
  AND NOT EXISTS (SELECT 1 FROM points p WHERE p.sample_id = g.sample_id AND p.point = g.frame AND p.point % 2 = 0)""")
def ses03(spark, sf_dir):
    v = votes(spark, sf_dir)
    return V.dense_micro(voted(v), V.clusters(v, FPS).filter("point % 2 = 0"), F.lit(END), FPS)


@query("join07_missing_points", f"WITH {CLUSTERS_SQL} SELECT p.* FROM points p WHERE NOT EXISTS (SELECT 1 FROM points k WHERE k.sample_id = p.sample_id AND k.point % 3 = 0 AND abs(k.point - p.point) <= 12)")
def join07(spark, sf_dir):
    p = V.clusters(votes(spark, sf_dir), FPS)
    return V.missing(p, p.filter("point % 3 = 0").withColumnRenamed("point", "frame"), 12)


@query("join08_supporting_windows", f"WITH {CLUSTERS_SQL} SELECT p.sample_id, p.point, count(DISTINCT v.window_id) AS windows FROM points p LEFT JOIN votes v ON v.sample_id = p.sample_id AND abs(v.frame - p.point) <= 30 GROUP BY ALL")
def join08(spark, sf_dir):
    v = votes(spark, sf_dir)
    return V.supporting_windows(V.clusters(v, FPS), v, 30)


@query("join09_neighbourhood", f"WITH {CLUSTERS_SQL} SELECT *, sum(support) OVER (PARTITION BY sample_id ORDER BY point RANGE BETWEEN 30 PRECEDING AND 30 FOLLOWING) AS around FROM points")
def join09(spark, sf_dir):
    return V.neighbourhood(V.clusters(votes(spark, sf_dir), FPS), 30)


@query("set01_cut_points", f"WITH {CLUSTERS_SQL}, {REPEATS_SQL.removeprefix(VOTES_SQL + ', ')} SELECT sample_id, point FROM points UNION SELECT sample_id, frame FROM voted")
def set01(spark, sf_dir):
    v = votes(spark, sf_dir)
    return V.clusters(v, FPS).select("sample_id", "point").union(voted(v).select("sample_id", "frame")).distinct()


FROM_POINTS_SQL = f"""{CLUSTERS_SQL}, ids AS (SELECT DISTINCT sample_id FROM votes),
ap AS (SELECT sample_id, point, max(support) AS support FROM (SELECT * FROM points WHERE point > 0 AND point < {END} UNION ALL SELECT sample_id, unnest([0, {END}]), NULL FROM ids) GROUP BY ALL),
fp AS (SELECT sample_id, point AS start_frame, lead(point) OVER w AS end_excl, support AS support_before, lead(support) OVER w AS support_after, row_number() OVER w - 1 AS seg_id FROM ap WINDOW w AS (PARTITION BY sample_id ORDER BY point)),
cut AS (SELECT * FROM fp WHERE end_excl IS NOT NULL)"""


def cut_segments(spark, sf_dir):
    v = votes(spark, sf_dir)
    return S.from_points(V.clusters(v, FPS), v.select("sample_id").distinct().withColumn("nframes", F.lit(END).cast("long")))


@query("wfn01_segments", f"WITH {FROM_POINTS_SQL} SELECT sample_id, seg_id, start_frame, end_excl, support_before, support_after FROM cut")
def wfn01(spark, sf_dir):
    return cut_segments(spark, sf_dir)


@query("wfn02_strong_boundaries", f"WITH {FROM_POINTS_SQL} SELECT sample_id, seg_id, end_excl AS frame, support_after AS support FROM (SELECT *, lead(seg_id) OVER (PARTITION BY sample_id ORDER BY seg_id) AS nxt FROM cut) WHERE nxt IS NOT NULL AND support_after >= 300")
def wfn02(spark, sf_dir):
    return S.inner_boundaries(cut_segments(spark, sf_dir), 300.0)


@query("agg05_majority_text", f"""WITH {FROM_POINTS_SQL}, tl AS (SELECT sample_id, frame, event_id AS ord, 'step ' || repeat_index AS txt FROM votes WHERE weight > 20),
b AS (SELECT *, start_frame + CAST(floor((end_excl - start_frame) * 0.2::DOUBLE) AS BIGINT) AS lo, greatest(start_frame + CAST(floor((end_excl - start_frame) * 0.2::DOUBLE) AS BIGINT) + 1, end_excl - CAST(floor((end_excl - start_frame) * 0.2::DOUBLE) AS BIGINT)) AS hi FROM cut),
m AS (SELECT b.sample_id, seg_id, txt, count(*) FILTER (WHERE frame >= lo AND frame < hi) AS mid, count(*) AS n, min(frame * 1000000 + ord) AS f, min(frame * 1000000 + ord) FILTER (WHERE frame >= lo AND frame < hi) AS mf
  FROM b JOIN tl ON tl.sample_id = b.sample_id AND frame >= start_frame AND frame < end_excl GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY sample_id, seg_id ORDER BY mid > 0 DESC, CASE WHEN mid > 0 THEN mid ELSE n END DESC, CASE WHEN mid > 0 THEN mf ELSE f END) AS k FROM m)
SELECT c.sample_id, c.seg_id, coalesce(txt, 'Unknown task step') AS instruction FROM cut c LEFT JOIN r ON r.sample_id = c.sample_id AND r.seg_id = c.seg_id AND k = 1""")
def agg05(spark, sf_dir):
    t = votes(spark, sf_dir).filter("weight > 20").select("sample_id", "frame", F.col("event_id").alias("ord"), F.concat(F.lit("step "), F.col("repeat_index").cast("string")).alias("instruction"))
    return S.majority_texts(cut_segments(spark, sf_dir), t)
