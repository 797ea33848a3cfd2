"""Queries of the boundary evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import evaluate
from ..sources.fixtures import SEGMENTS_SQL, segments
from .catalog import query

BOUNDS_SQL = f"""{SEGMENTS_SQL},
inner_ends AS (SELECT sample_id, seg_id AS idx, end_excl AS frame, part FROM (SELECT *, lead(seg_id) OVER (PARTITION BY sample_id ORDER BY seg_id) AS nxt FROM segments) WHERE nxt IS NOT NULL),
gt AS (SELECT sample_id, idx, frame FROM inner_ends), pred AS (SELECT sample_id, frame + part % 61 - 30 AS frame FROM inner_ends WHERE part % 7 <> 0)"""
MATCH_SQL = f"""{BOUNDS_SQL},
g AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY frame, idx) - 1 AS k FROM gt),
p AS (SELECT sample_id, list(frame ORDER BY frame) AS l FROM pred GROUP BY sample_id),
s AS (SELECT DISTINCT g.sample_id, coalesce(p.l, CAST([] AS BIGINT[])) AS l FROM g LEFT JOIN p USING (sample_id)),
r AS (SELECT sample_id, CAST(-1 AS BIGINT) AS k, CAST(0 AS BIGINT) AS nxt, CAST(NULL AS BIGINT) AS hit FROM s
  UNION ALL
  SELECT sample_id, k, CASE WHEN l[i + 1] <= frame + 5 THEN i + 1 ELSE coalesce(i, len(l)) END, CASE WHEN l[i + 1] <= frame + 5 THEN i END
  FROM (SELECT r.sample_id, g.k, g.frame, s.l, list_filter(range(r.nxt, len(s.l)), lambda j: s.l[j + 1] >= g.frame - 5)[1] AS i
        FROM r JOIN g ON g.sample_id = r.sample_id AND g.k = r.k + 1 JOIN s ON s.sample_id = r.sample_id)),
used AS (SELECT sample_id, list(hit) FILTER (WHERE hit IS NOT NULL) AS u FROM r GROUP BY sample_id),
m AS (SELECT g.sample_id, g.idx, g.frame, r.hit IS NOT NULL AS hit, CASE WHEN r.hit IS NOT NULL THEN s.l[r.hit + 1] ELSE
    list_sort(list_transform(list_filter(range(len(s.l)), lambda j: NOT coalesce(list_contains(u.u, j), false)), lambda j: [abs(s.l[j + 1] - g.frame), s.l[j + 1]]))[1][2] END AS pred_frame
  FROM g JOIN r USING (sample_id, k) JOIN s USING (sample_id) JOIN used u USING (sample_id))"""


def boundaries(spark, sf_dir):
    s = segments(spark, sf_dir)
    inner = s.withColumn("nxt", F.lead("seg_id").over(Window.partitionBy("sample_id").orderBy("seg_id"))).filter("nxt IS NOT NULL")
    return inner.select("sample_id", F.col("seg_id").alias("idx"), F.col("end_excl").alias("frame")), inner.filter("part % 7 <> 0").select("sample_id", (F.col("end_excl") + F.col("part") % 61 - 30).alias("frame"))


@query("src10_boundaries", f"WITH {BOUNDS_SQL} SELECT sample_id, idx, frame FROM gt")
def src10(spark, sf_dir):
    return boundaries(spark, sf_dir)[0]


@query("join10_greedy_match", f"WITH RECURSIVE {MATCH_SQL} SELECT sample_id, idx, pred_frame FROM m WHERE hit")
def join10(spark, sf_dir):
    return evaluate.matches(*boundaries(spark, sf_dir)).filter("hit").select("sample_id", "idx", "pred_frame")


@query("join11_nearest", f"WITH RECURSIVE {MATCH_SQL} SELECT sample_id, idx, frame, pred_frame, pred_frame - frame AS delta, hit FROM m")
def join11(spark, sf_dir):
    return evaluate.matches(*boundaries(spark, sf_dir))


@query("agg16_recall", f"""WITH RECURSIVE {MATCH_SQL},
a AS (SELECT sample_id, count(*) AS gt_count, count(*) FILTER (WHERE hit) AS hit_count, avg(abs(pred_frame - frame)) FILTER (WHERE hit) AS mean_delta,
  CAST(median(abs(pred_frame - frame)) FILTER (WHERE hit) AS DOUBLE) AS median_delta, max(abs(pred_frame - frame)) FILTER (WHERE hit) AS max_delta FROM m GROUP BY sample_id),
n AS (SELECT sample_id, count(*) AS pred_count FROM pred GROUP BY sample_id)
SELECT sample_id, coalesce(gt_count, 0) AS gt_count, coalesce(pred_count, 0) AS pred_count, coalesce(hit_count, 0) AS hit_count,
  coalesce(gt_count, 0) - coalesce(hit_count, 0) AS miss_count, CASE WHEN coalesce(gt_count, 0) > 0 THEN hit_count / gt_count ELSE 0.0::DOUBLE END AS recall, mean_delta, median_delta, max_delta
FROM a FULL JOIN n USING (sample_id)""")  # fmt: skip
def agg16(spark, sf_dir):
    return evaluate.recall(*boundaries(spark, sf_dir))
