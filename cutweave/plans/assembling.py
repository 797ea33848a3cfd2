"""Queries of cleaning, boundary shifts, guards and the whole assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..operators import assembly as A
from ..operators import wording as D
from ..operators import windows as W
from ..sources import logs as L
from ..sources.fixtures import SEGMENTS_SQL, segments
from ..sources.scratch import settled, spread
from . import wording as P
from .catalog import query
from .recorded import logged

SHORT = "(end_excl - start_frame) / 30.0::DOUBLE"


@query("txt12_full_families", f"WITH {P.DESCRIBED_SQL} SELECT instruction, array_to_string(list_filter([{', '.join('CASE WHEN ' + P.any_('all_words', v) + f' THEN {chr(39)}{k}{chr(39)} END' for k, v in sorted(A.FULL_FAMILIES.items()))}], lambda f: f IS NOT NULL), ' ') AS families FROM d")
def txt12(spark, sf_dir):
    return P.distinct(spark, sf_dir).select("instruction", F.array_join(A.full_families(F.col("all_words")), " ").alias("families"))


NONMOVE = {k: v for k, v in A.FULL_FAMILIES.items() if k != "transfer"}
KINDS_SQL = "(" + " + ".join(f"CASE WHEN {P.any_('all_words', v)} THEN 1 ELSE 0 END" for v in NONMOVE.values()) + ")"


@query("pred01_wants_refinement", f"WITH {P.DESCRIBED_SQL}, x AS (SELECT instruction || CASE WHEN len(instruction) % 2 = 0 THEN ', done' ELSE '' END AS txt, {KINDS_SQL} AS kinds, {P.any_('all_words', ['base', 'content', 'contents', 'mixture', 'sauce'])} AS phase FROM d) SELECT txt, (contains(lower(txt), ' and ') OR contains(lower(txt), ' then ') OR contains(txt, ',')) AND (kinds >= 2 OR (kinds >= 1 AND phase)) AS wants FROM x")
def pred01(spark, sf_dir):
    d = P.distinct(spark, sf_dir)
    text = F.concat("instruction", F.when(F.length("instruction") % 2 == 0, ", done").otherwise(""))
    return d.select(text.alias("txt"), A.wants_refinement(text, F.col("all_words")).alias("wants"))


@query("pred05_preparations", f"WITH {P.DESCRIBED_SQL} SELECT instruction, starts_with(low, 'reach ') OR {' OR '.join(f'contains(low, {chr(39)}{p}{chr(39)})' for p in A.GRIPPER_PHRASES)} OR ({P.any_('all_words', ['prepare'], A.POSITIONING)} AND NOT {P.any_('all_words', A.COMPLETION)}) AS preparation, len(prim) = 0 AND {P.any_('all_words', ['area', 'arm', 'gripper', 'robot', 'work', 'workspace'])} AS bridge FROM d")
def pred05b(spark, sf_dir):
    return P.distinct(spark, sf_dir).select("instruction", A.is_preparation(F.col("instruction"), F.col("all_words")).alias("preparation"), A.is_bridge(F.col("all_words"), F.col("primary")).alias("bridge"))


@query("fold03_cleaned")
def fold03(spark, sf_dir):
    return A.cleaned(segments(spark, sf_dir))


def picks(s):
    return s.filter("part % 3 = 0").select("sample_id", "seg_id", (F.col("end_excl") + (F.col("part") % 11 - 5) * 40).alias("frame"))


@query("fold05_shifted_boundaries", f"""WITH RECURSIVE {SEGMENTS_SQL}, p AS (SELECT s.*, CASE WHEN part % 3 = 0 THEN end_excl + (part % 11 - 5) * 40 END AS pick, lead(end_excl) OVER (PARTITION BY sample_id ORDER BY seg_id) AS nxt FROM segments s),
c AS (SELECT *, CASE WHEN pick IS NOT NULL AND greatest(start_frame + 1, least(pick, nxt - 1)) BETWEEN start_frame + 1 AND nxt - 1 THEN greatest(start_frame + 1, least(pick, nxt - 1)) ELSE end_excl END AS place FROM p),
r AS (SELECT sample_id, seg_id, start_frame AS s, CASE WHEN nxt IS NULL THEN end_excl ELSE greatest(start_frame + 1, least(place, nxt - 1)) END AS e FROM c WHERE seg_id = 0
  UNION ALL SELECT c.sample_id, c.seg_id, r.e, CASE WHEN c.nxt IS NULL THEN c.end_excl ELSE greatest(r.e + 1, least(c.place, c.nxt - 1)) END FROM r JOIN c ON c.sample_id = r.sample_id AND c.seg_id = r.seg_id + 1)
SELECT sample_id, seg_id, s AS start_frame, e AS end_excl FROM r""")
def fold05(spark, sf_dir):
    s = segments(spark, sf_dir)
    return A.shifted_boundaries(s, picks(s)).select("sample_id", "seg_id", "start_frame", "end_excl")


def told(s):
    """Refinements of two thirds of the boundaries: a third names a frame (after one that is out of range), a third none."""
    at = F.col("end_excl") + (F.col("part") % 11 - 5) * 40
    pick = F.when(F.col("part") % 3 == 0, F.array(F.lit(9), F.lit(1))).otherwise(F.array().cast("array<int>"))
    texts = F.when(F.col("part") % 4 == 0, F.array(F.lit("one"), F.lit("two"))).otherwise(F.array(F.lit("one"), F.lit(" ")))
    return s.filter("part % 3 < 2").select("sample_id", "seg_id", F.array(at - 40, at, at + 40).alias("frame_ids"), pick.alias("transitions"), texts.alias("instructions"))


TOLD_SQL = f"""WITH RECURSIVE {P.DESCRIBED_SQL}, p AS (SELECT s.*, lead(end_excl) OVER w AS nxt, lead(support_before) OVER w AS nb, row_number() OVER w AS k FROM segments s WINDOW w AS (PARTITION BY sample_id ORDER BY seg_id)),
q AS (SELECT *, CASE WHEN part % 3 = 0 THEN end_excl + (part % 11 - 5) * 40 END AS pick, greatest(0.0, coalesce(support_after, 0.0), coalesce(nb, 0.0)) AS support, support_after IS NOT NULL OR nb IS NOT NULL AS known FROM p),
b AS (SELECT *, nxt IS NOT NULL AND part % 3 = 1 AND part % 4 <> 0 AND support <= 0.6 AS gone,
  CASE WHEN pick IS NOT NULL AND greatest(start_frame + 1, least(pick, nxt - 1)) BETWEEN start_frame + 1 AND nxt - 1 THEN greatest(start_frame + 1, least(pick, nxt - 1)) ELSE end_excl END AS place FROM q),
r AS (SELECT sample_id, k, start_frame AS s, end_excl AS e, instruction AS txt, confidence AS conf, support_before AS sb, support_after AS sa FROM b WHERE k = 1
  UNION ALL SELECT x.sample_id, x.k, CASE WHEN y.gone THEN s ELSE cut END, x.end_excl, CASE WHEN NOT y.gone THEN x.instruction
      WHEN list_has_any(l.ingredients, m.ingredients) AND {P.any_('l.head', X.PREP_INGREDIENT)} AND {P.any_('m.head', X.PREP_INGREDIENT)} AND NOT list_has_any(l.actions, m.actions) THEN x.instruction
      WHEN m.specificity > l.specificity THEN x.instruction WHEN l.specificity > m.specificity THEN txt WHEN (x.end_excl - x.start_frame) / 30.0::DOUBLE >= 0.75 * ((x.end_excl - s) / 30.0::DOUBLE) THEN x.instruction ELSE txt END,
    CASE WHEN y.gone THEN conf ELSE x.confidence END, CASE WHEN y.gone THEN sb WHEN y.known THEN y.support ELSE x.support_before END, CASE WHEN y.gone THEN coalesce(x.support_after, sa) ELSE x.support_after END
  FROM (SELECT r.*, b.gone, b.known, b.support, greatest(r.s + 1, least(b.place, b.nxt - 1)) AS cut FROM r JOIN b ON b.sample_id = r.sample_id AND b.k = r.k) y
  JOIN b x ON x.sample_id = y.sample_id AND x.k = y.k + 1 JOIN d l ON l.instruction = txt JOIN d m ON m.instruction = x.instruction)
SELECT r.sample_id, row_number() OVER (PARTITION BY r.sample_id ORDER BY r.k) - 1 AS seg_id, s AS start_frame, CASE WHEN nxt IS NULL THEN e ELSE greatest(s + 1, least(place, nxt - 1)) END AS end_excl, txt AS instruction, conf AS confidence, sb AS support_before,
  CASE WHEN nxt IS NOT NULL AND known THEN support ELSE sa END AS support_after FROM r JOIN b USING (sample_id, k) WHERE NOT gone"""


@query("fold05_refined_boundaries", TOLD_SQL)
def fold05b(spark, sf_dir):
    s = segments(spark, sf_dir)
    return A.refined_boundaries(s, told(s), 30.0, 0.6)


@query("pred09_overcollapsed", f"""WITH {P.DESCRIBED_SQL}, m AS (SELECT sample_id, seg_id // 4 AS seg_id, min(start_frame) AS s, max(end_excl) AS e FROM segments GROUP BY sample_id, seg_id // 4), md AS (SELECT sample_id, median({SHORT}) AS med FROM segments GROUP BY ALL),
x AS (SELECT m.sample_id, m.seg_id, s, e, count(*) AS n, count(DISTINCT CASE WHEN NOT (generic OR prep_like OR filler) THEN lower(trim(g.instruction)) END) AS k FROM m JOIN segments g ON g.sample_id = m.sample_id AND g.start_frame < e AND s < g.end_excl JOIN d ON d.instruction = g.instruction GROUP BY ALL)
SELECT x.sample_id, x.seg_id FROM x JOIN md USING (sample_id) WHERE n >= 3 AND k >= 2 AND (e - s) / 30.0::DOUBLE >= greatest(10.0, med * 1.8)""")
def pred09(spark, sf_dir):
    s = segments(spark, sf_dir)
    merged = s.groupBy("sample_id", F.floor(F.col("seg_id") / 4).cast("long").alias("seg_id")).agg(F.min("start_frame").alias("start_frame"), F.max("end_excl").alias("end_excl"))
    return A.overcollapsed(merged, s)


@query("sel06_selection_policy")
def sel06(spark, sf_dir):
    s = segments(spark, sf_dir)
    texts = D.glossary(s)  # later steps choose among these texts
    light = settled(A.cleaned(s, texts=texts))
    merged = settled(A.cleaned(D.merge_tasks(light, 30.0, 0.9, texts), texts=texts))
    micro = light.filter("seg_id % 7 = 6").select("sample_id", F.col("end_excl").alias("point"))
    return A.selection_policies(light, merged, micro, 30.0, 0.5, texts=texts)


@query("fold07_assembled")
def fold07(spark, sf_dir):
    # lines are dear to parse and a file may be one task: they are dealt by sample, kept (a filter would be moved ahead of that) and parsed once
    found = settled(L.window_results(settled(spread(logged(spark, sf_dir), "sample_id")), 12))
    ids = found.select("sample_id").distinct().withColumns({"fps": F.lit(30.0), "nframes": F.lit(1700).cast("long")})
    windows = W.hop_windows(ids, 12.0, 6.0, 12)
    return A.assembled(found, windows, ids.select("sample_id", "nframes"), 12)
