"""Source divergence audit: how each source's terms differ from those of the other sources of its language.

A first pass puts each document's distinct terms into count-min sketches of document frequencies, one a task, merged in a tree. A
sketch never underestimates, so a term that it shows below the least number of documents cannot be kept, and the second pass drops
it before anything is shuffled. What survives is counted exactly. Pairs of sources are compared by joins of the terms that both
have; terms that one or neither has follow from the sources' totals and from how often each count occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .runs import LETTERS, runs_of
from .words import Words, mix, slices

#: Documents of a language in which a term must occur.
LEAST = 3
#: Terms that are reported for a source.
TOP = 200
#: Parts of one in which probabilities are counted.
ONE = 1_000_000_000
#: Rows and cells of a row (a power of two) of a sketch, a byte a cell: its size in every task, and what is sent to all tasks.
ROWS, CELLS = 2, 1 << 22
#: Cells that are merged together, and sketches that one task merges at a time in the first step.
TILE, FAN = 1 << 16, 64
#: Bytes of texts that are read at a time.
TEXTS = 1 << 22


def cells_of(keys: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Each key's cell in every row."""
    at = np.empty((ROWS, len(keys)), np.int64)
    for row in range(ROWS):
        at[row] = (mix(keys + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (1 << 64) - 1)) >> np.uint64(8)) & np.uint64(cells - 1)
        at[row] += row * cells
    return at


def _hashes(terms: pa.Array) -> np.ndarray:
    """A hash of each string, a function of its bytes alone: of at most 64 of them and of how many there are."""
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    raw = np.frombuffer(terms.buffers()[2], np.uint8) if terms.buffers()[2] is not None else np.zeros(0, np.uint8)
    start, end = offsets[:-1], np.minimum(offsets[1:], offsets[:-1] + 64)
    return Words(raw, start, end, start, start, raw).hashes() ^ mix((offsets[1:] - start).astype(np.uint64))


def distinct(keys: np.ndarray) -> np.ndarray:
    """The keys once each, ascending; by sorting, which is faster here than a table of hashes."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


class Slice:
    """Terms of some documents. terms: the distinct ones; code, doc: of each occurrence; lang, source: codes of each document."""

    def __init__(self, batch: pa.RecordBatch):
        runs = runs_of(batch.column("text"), LETTERS)
        coded = runs.strings().dictionary_encode()
        self.terms, self.doc = coded.dictionary, runs.doc
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lang, source = (batch.column(c).cast(pa.large_string()).dictionary_encode() for c in ("lang", "source"))
        self.langs, self.sources = lang.dictionary, source.dictionary
        self.lang, self.source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, source))
        self.n = max(len(self.terms), 1)

    def keys(self, at: np.ndarray) -> np.ndarray:
        """Hashes of (language, term), given as language * n + term."""
        return mix(_hashes(self.langs)[at // self.n] + np.uint64(0x9E3779B97F4A7C15)) ^ _hashes(self.terms)[at % self.n]

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (language, term) and in how many documents of these each occurs."""
        once = distinct(self.doc * self.n + self.code)
        return np.unique(self.lang[once // self.n] * self.n + once % self.n, return_counts=True)


def terms_read(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])


def sketched(texts: DataFrame, least: int, cells: int = CELLS) -> np.ndarray:
    """The merged sketch of document frequencies, cells at most least (so a byte holds them)."""
    top = min(least, 255)

    def read(batches):
        sketch = np.zeros(ROWS * cells, np.uint8)
        for batch in batches:
            for some in slices(batch, "text", TEXTS):
                part = Slice(some)
                at, docs = part.documents()
                for row in cells_of(part.keys(at), cells):
                    cell, inverse = np.unique(row, return_inverse=True)
                    sketch[cell] = np.minimum(sketch[cell] + np.bincount(inverse, docs), top)
        yield from tiles({i: t for i, t in enumerate(sketch.reshape(-1, TILE)) if t.any()}, TaskContext.get().partitionId())

    def tiles(held: dict[int, np.ndarray], task: int) -> Iterator[pa.RecordBatch]:
        for i, t in held.items():
            packed = pa.Codec("zstd").compress(t.tobytes(), asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([task % FAN], pa.int32()), pa.array([packed], pa.binary())], ["tile", "task", "cells"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column("tile").to_pylist(), batch.column("cells"), strict=True):
                tile = np.frombuffer(pa.Codec("zstd").decompress(packed.as_py(), TILE, asbytes=True), np.uint8)
                held[i] = np.minimum(held[i].astype(np.uint16) + tile, top).astype(np.uint8) if i in held else tile
        yield from tiles(held, TaskContext.get().partitionId())

    kind, n = "tile int, task int, cells binary", int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = texts.mapInArrow(read, kind).repartition(n, "tile", "task").mapInArrow(merge, kind)
    whole = some.repartition(n, "tile").mapInArrow(merge, kind).select("tile", "cells")
    sketch = np.zeros(ROWS * cells, np.uint8)
    for row in whole.collect():  # a row for each tile, ROWS * cells bytes at most
        sketch[row["tile"] * TILE : (row["tile"] + 1) * TILE] = np.frombuffer(pa.Codec("zstd").decompress(bytes(row["cells"]), TILE, asbytes=True), np.uint8)
    return sketch


def counted(texts: DataFrame, sketch: np.ndarray, least: int) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of the terms that the sketch does not rule out, in parts."""
    held, top = texts.sparkSession.sparkContext.broadcast(sketch), min(least, 255)  # ROWS * cells bytes

    def run(batches):
        sketch = held.value
        for batch in batches:
            for some in slices(batch, "text", TEXTS):
                part = Slice(some)
                if not len(part.terms):
                    continue
                at, _ = part.documents()
                at = at[np.all(sketch[cells_of(part.keys(at), len(sketch) // ROWS)] >= top, axis=0)]
                # (language, source, term) of each occurrence whose (language, term) is left
                group = part.lang * len(part.sources) + part.source
                own = part.lang[part.doc] * part.n + part.code
                slot = np.minimum(np.searchsorted(at, own), max(len(at) - 1, 0))
                left = np.flatnonzero(at[slot] == own) if len(at) else np.zeros(0, np.int64)
                once, times = np.unique(part.doc[left] * part.n + part.code[left], return_counts=True)
                key, inverse = np.unique(group[once // part.n] * part.n + once % part.n, return_inverse=True)
                groups = key // part.n
                yield pa.RecordBatch.from_arrays(
                    [
                        part.langs.take(pa.array(groups // len(part.sources))).cast(pa.string()), part.sources.take(pa.array(groups % len(part.sources))).cast(pa.string()), part.terms.take(pa.array(key % part.n)).cast(pa.string()),
                        pa.array(np.bincount(inverse, times, len(key)).astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(key)).astype(np.int64)),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(texts: DataFrame, least: int = LEAST, cells: int = CELLS) -> DataFrame:
    """lang, source, term, n, lang_n: occurrences of each kept term in a source and in the whole language."""
    parts = counted(texts, sketched(texts, least, cells), least)
    sums = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")  # a row for each source
    return sums.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term)}).filter(F.col("lang_docs") >= least).drop("docs", "lang_docs")


#: Probability in parts of ONE of what occurs {n} times, and the squared distance of p from q in parts of q; exact integers.
CHANCE = f"1 + (CAST({ONE} AS DECIMAL(10,0)) * CAST({{n}} + 1 AS DECIMAL(19,0))) DIV (CAST({{total}} AS DECIMAL(19,0)) + kinds)"
FAR = "({p} - {q}) * ({p} - {q}) DIV {q}"


def chance(n: str, total: str) -> str:
    return CHANCE.format(n=n, total=total)


def far(p: str, q: str) -> str:
    return FAR.format(p=p, q=q)


def totals(texts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total and have (occurrences and number of its kept terms), kinds and lang_total (number and occurrences of the
    language's kept terms), zero (the probability of a kept term that it lacks) for each occurring pair."""
    groups = texts.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("have"))
    kinds = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("kinds"))
    both = groups.join(own, ["lang", "source"], "left").join(kinds, "lang", "left").fillna(0, ["total", "have", "lang_total", "kinds"])
    return both.withColumn("zero", F.expr(f"CASE WHEN kinds > 0 THEN {chance('0', 'total')} END"))


def pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source), value: the distances of all kept terms of the language, summed.

    Where only one of two sources has a term, the distance depends on its count alone, so terms are added by count; terms that both
    have are met by a join, as what they add to that; terms that neither has are as many as are left, all at one distance.
    """
    a = rows.select("lang", "term", *[F.col(c).alias(f"a_{c}") for c in ("source", "p", "zero")])
    b = rows.select("lang", "term", *[F.col(c).alias(f"b_{c}") for c in ("source", "p", "zero")])
    more = lambda x, y: F.expr(f"{far(f'{x}_p', f'{y}_p')} - {far(f'{x}_p', f'{y}_zero')} - {far(f'{x}_zero', f'{y}_p')} + {far(f'{x}_zero', f'{y}_zero')}")
    met = a.join(b, ["lang", "term"]).filter("a_source < b_source")
    met = met.groupBy("lang", "a_source", "b_source").agg(F.sum(more("a", "b")).alias("ab"), F.sum(more("b", "a")).alias("ba"))

    counts = rows.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    other = groups.filter("kinds > 0").select("lang", F.col("source").alias("item"), F.col("zero").alias("q"))
    one = counts.join(other, "lang").filter("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.expr(f"times * ({far('p', 'q')})")).alias("ab"), F.sum(F.expr(f"times * ({far('q', 'p')})")).alias("ba"))

    left = groups.select("lang", F.col("source").alias("item"), F.col("have").alias("item_have"), F.col("zero").alias("item_zero"))
    none = groups.join(left, "lang").filter("source <> item").select("lang", "source", "item", F.expr(f"CASE WHEN kinds > 0 THEN (kinds - have - item_have) * ({far('zero', 'item_zero')}) ELSE 0 END").alias("value"))

    def both_ways(df: DataFrame, x: str, y: str) -> DataFrame:
        return df.select("lang", F.explode(F.array(F.struct(F.col(x).alias("source"), F.col(y).alias("item"), F.col("ab").alias("value")), F.struct(F.col(y).alias("source"), F.col(x).alias("item"), F.col("ba").alias("value")))).alias("s")).select("lang", "s.*")

    parts = none.unionByName(both_ways(met, "a_source", "b_source")).unionByName(both_ways(one, "source", "item"))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language its other sources by how far its terms are from theirs
    (part pair, all ranks), and its terms by how far they stand out from the language (part term, ranks to top).

    Terms are runs of letters (A-Z lower-cased) and of anything that is not ASCII; a language keeps those in at least so many of its
    documents. A source's probability of a kept term that occurs n times is p = 1 + floor(1e9 (n + 1) / (N + V)), N its occurrences
    of all V kept terms; a distance is floor((p - q)^2 / q). NULL texts, languages and sources count as ''. Sources without terms
    are compared as well; a language without kept terms has distances 0; a single source has no pair; an empty table gives no rows.
    Repeated rows count as documents of their own, ties go to the item that comes first in UTF-8, further columns are left out.
    Sums stay within 64 bits up to 5e8 kept terms in a language; beyond, the job fails.
    """
    texts = terms_read(docs, text_col, lang_col, source_col)
    kept = written(kept_terms(texts, least, cells), "kept")
    groups = written(totals(texts, kept), "groups")
    rows = written(kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "zero", F.expr(chance("n", "total")).alias("p"), F.expr(chance("lang_n", "lang_total")).alias("q")), "chances")
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pairs(rows, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(own).alias("rank"))
    term = rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(far("p", "q")).alias("value"))
    term = term.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(own).alias("rank")).filter(F.col("rank") <= top)
    return pair.unionByName(term)


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(w) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), kinds AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), sources AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (s.total + v.v) AS p, 1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // (v.total + v.v) AS q
  FROM sources s JOIN kinds v ON s.lang = v.lang JOIN kept k ON k.lang = s.lang LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""
