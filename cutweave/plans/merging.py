"""Queries of segment overlaps, partitions and merged ranges."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import hierarchy as H
from ..operators import segments as S
from ..sources.fixtures import SEGMENTS_SQL, segments
from .catalog import query

SIZES_SQL = "sizes AS (SELECT sample_id, count(*) AS n FROM segments GROUP BY ALL)"
BOUNDS_SQL = "bounds AS (SELECT sample_id, seg_id AS boundary FROM segments WHERE part % 3 <> 0)"
RANGES_SQL = f"""{SEGMENTS_SQL}, {SIZES_SQL}, {BOUNDS_SQL},
ends AS (SELECT DISTINCT b.sample_id, boundary AS end_idx FROM bounds b JOIN sizes USING (sample_id) WHERE boundary < n - 1 UNION ALL SELECT sample_id, n - 1 FROM sizes),
ranges AS (SELECT sample_id, coalesce(lag(end_idx) OVER (PARTITION BY sample_id ORDER BY end_idx) + 1, 0) AS start_idx, end_idx FROM ends)"""


def counted(s):
    """Segments with n, the number of their sample's: counted where they lie."""
    return s.withColumn("n", F.count("*").over(Window.partitionBy("sample_id")))


def parts(spark, sf_dir):
    """(segments, sizes, ranges) for the queries below."""
    s = segments(spark, sf_dir)
    sizes = s.groupBy("sample_id").agg(F.count("*").alias("n"))
    return s, sizes, S.ranges_from_boundaries(s.filter("part % 3 <> 0").select("sample_id", F.col("seg_id").alias("boundary")), sizes)


@query("prt03_ranges", f"WITH {RANGES_SQL} SELECT * FROM ranges")
def prt03(spark, sf_dir):
    return parts(spark, sf_dir)[2]


@query("prt02_boundaries", f"WITH {RANGES_SQL} SELECT sample_id, end_idx AS boundary FROM (SELECT *, lead(end_idx) OVER (PARTITION BY sample_id ORDER BY end_idx) AS nxt FROM ranges) WHERE nxt IS NOT NULL")
def prt02(spark, sf_dir):
    return S.boundaries_of_ranges(parts(spark, sf_dir)[2])


@query("prt01_sanitized_ranges", f"""WITH {RANGES_SQL}, extra AS (SELECT sample_id, seg_id AS boundary FROM segments WHERE support_after >= 0.9),
e AS (SELECT sample_id, end_idx FROM ranges UNION SELECT x.sample_id, boundary FROM extra x JOIN sizes USING (sample_id) WHERE boundary < n - 1)
SELECT sample_id, coalesce(lag(end_idx) OVER (PARTITION BY sample_id ORDER BY end_idx) + 1, 0) AS start_idx, end_idx FROM e""")
def prt01(spark, sf_dir):
    s, sizes, ranges = parts(spark, sf_dir)
    strong = s.filter("support_after >= 0.9").select("sample_id", F.col("seg_id").alias("boundary"))
    return S.ranges_from_boundaries(S.boundaries_of_ranges(ranges).unionByName(strong), sizes)


@query("prt04_identity_partition", f"WITH {SEGMENTS_SQL} SELECT sample_id, level, seg_id AS start_idx, seg_id AS end_idx FROM segments, (SELECT unnest(['coarse', 'fine']) AS level)")
def prt04(spark, sf_dir):
    return segments(spark, sf_dir).select("sample_id", F.explode(F.array(F.lit("coarse"), F.lit("fine"))).alias("level"), F.col("seg_id").alias("start_idx"), F.col("seg_id").alias("end_idx"))


@query("prt05_enabled_levels", "SELECT o_orderkey AS id, array_to_string(list_filter([CASE WHEN o_orderkey % 2 = 1 THEN 'coarse' END, CASE WHEN o_orderkey % 3 = 1 THEN 'medium' END, CASE WHEN o_orderkey % 5 = 1 THEN 'fine' END], lambda x: x IS NOT NULL), ' ') AS levels FROM orders")
def prt05(spark, sf_dir):
    from ..sources.fixtures import table

    on = [F.when(F.col("o_orderkey") % k == 1, name) for k, name in ((2, "coarse"), (3, "medium"), (5, "fine"))]
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(F.array_compact(F.array(*on)), " ").alias("levels"))


ASKED_SQL = f"""{RANGES_SQL}, asked AS (SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY end_idx) AS ord,
  start_idx + CASE WHEN sample_id % 7 = 0 AND start_idx > 0 THEN 1 ELSE 0 END AS start_id, CASE WHEN sample_id % 11 = 0 AND end_idx > 1 THEN NULL WHEN sample_id % 5 = 0 THEN end_idx - 1 ELSE end_idx END AS end_id
  FROM ranges WHERE sample_id % 13 <> 0)"""


def asked(spark, sf_dir):
    s, sizes, ranges = parts(spark, sf_dir)
    start = F.col("start_idx") + F.when((F.col("sample_id") % 7 == 0) & (F.col("start_idx") > 0), 1).otherwise(0)
    end = F.when((F.col("sample_id") % 11 == 0) & (F.col("end_idx") > 1), None).when(F.col("sample_id") % 5 == 0, F.col("end_idx") - 1).otherwise(F.col("end_idx"))
    ord_ = F.row_number().over(Window.partitionBy("sample_id").orderBy("end_idx"))
    return ranges.filter("sample_id % 13 <> 0").select("sample_id", ord_.alias("ord"), start.alias("start_id"), end.alias("end_id")), sizes


@query("val04_partition_reasons", f"""WITH {ASKED_SQL},
x AS (SELECT a.*, n, coalesce(lag(end_id) OVER (PARTITION BY a.sample_id ORDER BY ord) + 1, 0) AS expected FROM asked a JOIN sizes USING (sample_id)),
y AS (SELECT *, CASE WHEN start_id IS NULL OR end_id IS NULL THEN 'invalid_merged_ranges' WHEN start_id <> expected OR end_id < start_id OR end_id >= n THEN 'invalid_partition' END AS bad FROM x),
z AS (SELECT sample_id, n, arg_min(bad, ord) FILTER (WHERE bad IS NOT NULL) AS bad, arg_max(end_id, ord) AS last, count(*) AS ranges FROM y GROUP BY sample_id, n)
SELECT sample_id, CASE WHEN bad IS NOT NULL THEN bad WHEN last <> n - 1 THEN 'incomplete_partition' WHEN ranges < greatest(1, ceil(n * 0.35::DOUBLE)) THEN 'collapsed_too_aggressively' ELSE 'ok' END AS reason, ranges FROM z
UNION ALL SELECT sample_id, 'invalid_merged_ranges', 0 FROM sizes WHERE sample_id % 13 = 0""")
def val04(spark, sf_dir):
    ranges, sizes = asked(spark, sf_dir)
    return S.partition_reasons(ranges, sizes, 0.35)


@query("val05_least_outputs", f"WITH {RANGES_SQL} SELECT sample_id, CAST(greatest(1, ceil(n * 0.35::DOUBLE)) AS BIGINT) AS least FROM sizes")
def val05(spark, sf_dir):
    return parts(spark, sf_dir)[1].select("sample_id", S.least_outputs(F.col("n"), 0.35).alias("least"))


@query("agg07_merged_ranges", f"""WITH {RANGES_SQL},
m AS (SELECT r.sample_id, start_idx, end_idx, s.* EXCLUDE (sample_id) FROM ranges r JOIN segments s ON s.sample_id = r.sample_id AND seg_id BETWEEN start_idx AND end_idx),
a AS (SELECT sample_id, start_idx, arg_min(start_frame, seg_id) AS start_frame, arg_max(end_excl, seg_id) AS end_excl, sum(confidence * (end_excl - start_frame)) / sum(end_excl - start_frame) AS confidence,
  coalesce(max(support_before) FILTER (WHERE seg_id = start_idx), 0.0) AS support_before, coalesce(max(support_after) FILTER (WHERE seg_id = end_idx), 0.0) AS support_after, arg_min(trim(instruction), [-len(trim(instruction)), seg_id]) AS instruction FROM m GROUP BY ALL)
SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY start_idx) - 1 AS seg_id, start_frame, end_excl, instruction, round(confidence, 9) AS confidence, support_before, support_after FROM a""")
def agg07(spark, sf_dir):
    s, _, ranges = parts(spark, sf_dir)
    return S.merged_by_ranges(s, ranges).withColumn("confidence", F.round("confidence", 9))


CANDIDATES_SQL = f"""{SEGMENTS_SQL}, {SIZES_SQL}, candidates AS (SELECT s.sample_id, c AS candidate, seg_id AS boundary FROM segments s JOIN sizes USING (sample_id), (SELECT unnest(range(5)) AS c)
  WHERE seg_id < n - 1 AND (part * 7 + c * 13) % 5 < 3 AND (s.sample_id % 9 <> 0 OR c = 0))"""


def candidates(spark, sf_dir):
    s, sizes, _ = parts(spark, sf_dir)
    rows = counted(s).select("sample_id", "n", "part", "seg_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("candidate"))
    keep = (F.col("seg_id") < F.col("n") - 1) & ((F.col("part") * 7 + F.col("candidate") * 13) % 5 < 3) & ((F.col("sample_id") % 9 != 0) | (F.col("candidate") == 0))
    return rows.filter(keep).select("sample_id", "candidate", F.col("seg_id").alias("boundary")), sizes


@query("agg08_boundary_votes", f"WITH {CANDIDATES_SQL} SELECT sample_id, boundary, count(*) AS votes FROM candidates GROUP BY ALL")
def agg08(spark, sf_dir):
    return candidates(spark, sf_dir)[0].groupBy("sample_id", "boundary").agg(F.count("*").alias("votes"))


@query("agg09_consensus", f"""WITH {CANDIDATES_SQL}, k AS (SELECT sample_id, n, CASE WHEN sample_id % 9 = 0 THEN 1 ELSE 5 END AS k FROM sizes),
ok AS (SELECT c.sample_id, boundary, n FROM candidates c JOIN k USING (sample_id) GROUP BY c.sample_id, boundary, n, k HAVING k > 1 AND count(*) > k * 0.5),
e AS (SELECT sample_id, boundary AS end_idx, n FROM ok UNION ALL SELECT DISTINCT sample_id, n - 1, n FROM ok),
r AS (SELECT sample_id, coalesce(lag(end_idx) OVER (PARTITION BY sample_id ORDER BY end_idx) + 1, 0) AS start_idx, end_idx, count(*) OVER (PARTITION BY sample_id) AS m, n FROM e)
SELECT sample_id, start_idx, end_idx FROM r WHERE m >= greatest(1, ceil(n * 0.35::DOUBLE))""")
def agg09(spark, sf_dir):
    rows, sizes = candidates(spark, sf_dir)
    return S.boundary_consensus(rows, sizes.withColumn("candidates", F.when(F.col("sample_id") % 9 == 0, 1).otherwise(5)), 0.5, 0.35)


@query("agg10_candidate_choice", f"""WITH {CANDIDATES_SQL}, c AS (SELECT sample_id, candidate, count(*) AS b, count(*) + 1 AS outs FROM candidates GROUP BY ALL),
t AS (SELECT sample_id, count(*) // 2 + 1 AS quorum, list(outs ORDER BY outs)[count(*) // 2 + 1] AS median FROM c GROUP BY ALL),
v AS (SELECT sample_id, boundary, count(*) AS v FROM candidates GROUP BY ALL),
s AS (SELECT x.sample_id, x.candidate, count(*) AS sup FROM candidates x JOIN v USING (sample_id, boundary) JOIN t USING (sample_id) WHERE v >= quorum GROUP BY ALL),
a AS (SELECT c.*, coalesce(sup, 0) AS supported, quorum, median, max(coalesce(sup, 0)) OVER (PARTITION BY c.sample_id) AS top FROM c LEFT JOIN s USING (sample_id, candidate) JOIN t USING (sample_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY supported DESC, abs(outs - median), b - supported, supported / b DESC, candidate) AS k FROM a WHERE supported >= top - 1)
SELECT sample_id, candidate, supported, b - supported AS unsupported, outs AS outputs, quorum FROM r WHERE k = 1""")
def agg10(spark, sf_dir):
    rows, _ = candidates(spark, sf_dir)
    return S.candidate_choice(rows.groupBy("sample_id", "candidate").agg(F.collect_list("boundary").alias("boundaries")))


@query("val08_nesting_violations", f"WITH {RANGES_SQL}, i AS (SELECT sample_id, seg_id AS start_idx, least(seg_id + 1, n - 1) AS end_idx FROM segments JOIN sizes USING (sample_id)) SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM ranges r WHERE r.sample_id = i.sample_id AND r.start_idx <= i.start_idx AND i.end_idx <= r.end_idx)")
def val08(spark, sf_dir):
    s, sizes, ranges = parts(spark, sf_dir)
    inner = s.join(sizes, "sample_id").select("sample_id", F.col("seg_id").alias("start_idx"), F.least(F.col("seg_id") + 1, F.col("n") - 1).alias("end_idx"))
    return S.nesting_violations(ranges, inner)


@query("join06_overlaps", f"WITH {SEGMENTS_SQL} SELECT a.sample_id, a.seg_id, b.seg_id AS other_id, least(a.end_excl, b.end_excl + 45) - greatest(a.start_frame, b.start_frame + 45) AS overlap FROM segments a JOIN segments b ON a.sample_id = b.sample_id AND a.start_frame < b.end_excl + 45 AND b.start_frame + 45 < a.end_excl")
def join06(spark, sf_dir):
    s = segments(spark, sf_dir)
    return S.overlaps(s, s.withColumn("start_frame", F.col("start_frame") + 45).withColumn("end_excl", F.col("end_excl") + 45))


#: The ends of a level's ranges: those of the next level and more.
LEVELS = {"coarse": 8, "medium": 4, "fine": 2}
NODES_SQL = f"""{SEGMENTS_SQL}, {SIZES_SQL}, ends AS (SELECT sample_id, level, seg_id AS end_idx, n FROM segments JOIN sizes USING (sample_id), (VALUES {', '.join(f"('{k}', {v})" for k, v in LEVELS.items())}) AS l(level, every) WHERE part % every = 1 OR seg_id = n - 1),
nodes AS (SELECT *, coalesce(lag(end_idx) OVER (PARTITION BY sample_id, level ORDER BY end_idx) + 1, 0) AS start_idx FROM ends),
whole AS (SELECT x.sample_id, x.level, x.start_idx, x.end_idx, a.start_frame, b.end_excl AS end_frame, trim(a.instruction) AS summary FROM nodes x JOIN segments a ON a.sample_id = x.sample_id AND a.seg_id = x.start_idx JOIN segments b ON b.sample_id = x.sample_id AND b.seg_id = x.end_idx)"""


def level_ranges(spark, sf_dir):
    """(segments, ranges by level): partitions that are nested, with their first segment's text."""
    s = segments(spark, sf_dir)
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    ends = counted(s).select("sample_id", "seg_id", "instruction", *[((F.col("part") % v == 1) | (F.col("seg_id") == F.col("n") - 1)).alias(k) for k, v in LEVELS.items()])
    # a range begins after an end; its start and first text are the last ones begun
    begun = {k: F.when(F.coalesce(F.lag(k).over(w), F.lit(True)), F.struct(F.col("seg_id").alias("start_idx"), F.col("instruction").alias("summary"))).alias(f"{k}_begun") for k in LEVELS}
    rows = ends.select("sample_id", "seg_id", *LEVELS, *begun.values())
    level = F.array(*[F.when(F.col(k), F.struct(F.lit(k).alias("level"), F.last(f"{k}_begun", True).over(w).alias("first"))) for k in LEVELS])
    rows = rows.select("sample_id", F.col("seg_id").alias("end_idx"), level.alias("all")).select("sample_id", "end_idx", F.explode(F.array_compact("all")).alias("l"))
    return s, rows.select("sample_id", "l.level", "l.first.start_idx", "end_idx", "l.first.summary")


@query("join13_hierarchy", f"""WITH {NODES_SQL},
m AS (SELECT p.sample_id, p.start_idx, list(struct_pack(level := c.level, summary := c.summary, start_seg_id := c.start_idx, end_seg_id := c.end_idx, start_frame := c.start_frame, end_frame := c.end_frame) ORDER BY c.start_idx) AS children
  FROM whole p JOIN whole c ON p.sample_id = c.sample_id AND p.level = 'medium' AND c.level = 'fine' AND p.start_idx <= c.start_idx AND c.end_idx <= p.end_idx GROUP BY ALL),
k AS (SELECT p.sample_id, p.start_idx, list(struct_pack(level := c.level, summary := c.summary, start_seg_id := c.start_idx, end_seg_id := c.end_idx, start_frame := c.start_frame, end_frame := c.end_frame, children := m.children) ORDER BY c.start_idx) AS children
  FROM whole p JOIN whole c ON p.sample_id = c.sample_id AND p.level = 'coarse' AND c.level = 'medium' AND p.start_idx <= c.start_idx AND c.end_idx <= p.end_idx JOIN m ON m.sample_id = c.sample_id AND m.start_idx = c.start_idx GROUP BY ALL)
SELECT sample_id, CAST(to_json(list(struct_pack(level := level, summary := summary, start_seg_id := start_idx, end_seg_id := end_idx, start_frame := start_frame, end_frame := end_frame, children := children) ORDER BY start_idx)) AS VARCHAR) AS roots
FROM whole JOIN k USING (sample_id, start_idx) WHERE level = 'coarse' GROUP BY sample_id""")
def join13(spark, sf_dir):
    s, ranges = level_ranges(spark, sf_dir)
    return H.nested(ranges, s, list(LEVELS)).select("sample_id", F.to_json("roots").alias("roots"))


@query("mth05_boundary_support", f"WITH {SEGMENTS_SQL}, p AS (SELECT sample_id, seg_id, support_after AS a, lead(CASE WHEN part % 4 = 0 THEN NULL ELSE confidence END) OVER w AS b, lead(seg_id) OVER w AS nxt FROM segments WINDOW w AS (PARTITION BY sample_id ORDER BY seg_id)) SELECT sample_id, seg_id, greatest(0.0, coalesce(a, 0.0), coalesce(b, 0.0)) AS support, a IS NOT NULL OR b IS NOT NULL AS known FROM p WHERE nxt IS NOT NULL")
def mth05(spark, sf_dir):
    w = Window.partitionBy("sample_id").orderBy("seg_id")
    p = segments(spark, sf_dir).select("sample_id", "seg_id", "support_after", F.lead(F.when(F.col("part") % 4 != 0, F.col("confidence"))).over(w).alias("b"), F.lead("seg_id").over(w).alias("nxt")).filter("nxt IS NOT NULL")
    support, known = S.support_between(F.col("support_after"), F.col("b"))
    return p.select("sample_id", "seg_id", support.alias("support"), known.alias("known"))
