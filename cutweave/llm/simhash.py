"""SimHash near-duplicates: fingerprints of word shingles, links within a Hamming distance, connected components.

near_duplicates links fingerprints. one_of_each also verifies what the fingerprints propose: it links texts whose sets of shingles
have the asked Jaccard similarity, and keeps one of each group.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .components import components
from .pigeonhole import bit_counts, meetings, plan

DISTANCE, SHINGLE, SEED = 3, 3, 42
#: Near-duplicates of the pipeline: a Jaccard similarity of 4/5 on runs of five words. Sets that alike differ in 10 of 64 bits on
#: average; within NEAR_DISTANCE lie about 98 of 100 such pairs (README), and within NEAR_TOTAL of 128 all but one in 1,000, but
#: next to none of the pairs that are within NEAR_DISTANCE by chance.
NEAR_SHINGLE, NEAR, NEAR_DISTANCE, NEAR_TOTAL = 5, (4, 5), 14, 32
#: Bytes of a text whose words are held at a time.
SLICE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def shingles(text: str | None, k: int):
    """Arrays of the hashes of the text's runs of k words, repeats included, in order, a slice of the text at a time; of the whole
    sequence where it has fewer words; nothing without a word."""
    data = (text or "").encode().lower()  # of bytes: A-Z only, and the six ASCII white-space characters
    digest, words, at, none = xxhash.xxh64_intdigest, [], 0, True
    while at < len(data):
        space = SPACE.search(data, at + SLICE)
        end = space.start() if space else len(data)
        words += data[at:end].split()
        at = end
        if len(words) >= k:
            none = False
            yield np.fromiter((digest(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)), np.uint64, len(words) - k + 1)
            words = words[len(words) - k + 1 :]
    if none and words:
        yield np.array([digest(b" ".join(words), SEED)], np.uint64)


def _majority(slices) -> int:
    counts, n = np.zeros(64, np.int64), 0
    for h in slices:
        n += len(h)
        for at in range(0, len(h), 1 << 16):
            counts += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def simhash(text: str | None, k: int = SHINGLE) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the hashes of the text's shingles; 0 without a word."""
    return _majority(shingles(text, k))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingles(text, k)]))


def mixed(h: np.ndarray) -> np.ndarray:
    """64 other bits of each hash: a multiplication on both sides of a shift."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for each row of docs; NULL and wordless texts have 0."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = np.array([simhash(t.as_py()) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, fp long")


def _plan(nodes: DataFrame, distance: int) -> list:
    n = nodes.count()
    return plan(bit_counts(nodes), n, distance) if n > 1 and distance else []


def link(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fps(fp), distinct -> edges (u, v) that connect whatever a chain of links within distance connects."""
    nodes = fps.select(F.col("fp").alias("node"), "fp")
    return meetings(nodes, _plan(nodes, distance), distance)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id that links reach) for each row of docs.

    Rows with one id stay rows of their own; NULL and wordless texts share fingerprint 0 and are linked like any other; a NULL
    id is no smallest id unless there is no other; with distance 0 equal fingerprints alone are linked; an empty table gives no
    rows. Rows meet their component by fingerprint, of which the other side has one row each: the rows of one that is very
    frequent are split by the adaptive planner.
    """
    prints = written(fingerprints(docs, id_col, text_col), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    reached = components(link(classes.select("fp"), distance))
    rooted = written(classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def set_prints(rows: DataFrame, k: int) -> DataFrame:
    """rows(doc_id, th, text) -> doc_id, th, node (a hash of the set of shingles, 0 for none), n (its size), fp and more (two SimHashes of the set)."""

    def run(batches):
        for b in batches:
            sets = (shingle_set(t.as_py(), k) for t in b.column(2))
            made = [(xxhash.xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0, len(s), _majority([s]), _majority([mixed(s)])) for s in sets]
            values = (np.array(c, np.uint64).view(np.int64) for c in zip(*made, strict=True)) if made else [np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, values)], ["doc_id", "th", "node", "n", "fp", "more"])

    return rows.select("doc_id", "th", "text").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, th long, node long, n long, fp long, more long")


def sets_of(rows: DataFrame, classes: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(node, n, hashes) of the nodes in pairs(u, v), made again of the texts in question alone."""
    asked = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    of = written(classes.join(asked, "node").select("node", "n", F.col("th").alias("of_th")), "asked")
    texts = rows.join(of, F.col("th") == F.col("of_th")).dropDuplicates(["node"])

    def run(batches):
        for b in batches:
            sets = [shingle_set(t.as_py(), k).view(np.int64) for t in b.column(2)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))], ["node", "n", "hashes"])

    return written(texts.select("node", "n", "text").mapInArrow(run, "node long, n long, hashes array<long>"), "sets")


def alike(pairs: DataFrame, sets: DataFrame, near: tuple[int, int]) -> DataFrame:
    """The pairs(u, v) whose sets have a Jaccard similarity of near[0] / near[1] or more. Sizes alone rule out most others."""
    a, b = near
    sizes = sets.select("node", "n")
    fit = pairs.join(sizes.withColumnsRenamed({"node": "u", "n": "nu"}), "u").join(sizes.withColumnsRenamed({"node": "v", "n": "nv"}), "v")
    fit = written(fit.filter(b * F.least("nu", "nv") >= a * F.greatest("nu", "nv")), "fit")
    one = fit.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("hu")), "u")
    two = one.join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("hv")), "v")
    return written(two.filter(F.size(F.array_intersect("hu", "hv")) * (a + b) >= (F.col("nu") + F.col("nv")) * a).select("u", "v"), "links")


def one_of_each(docs: DataFrame, distance: int = NEAR_DISTANCE, shingle: int = NEAR_SHINGLE, near: tuple[int, int] = NEAR, total: int = NEAR_TOTAL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates: of each group that links connect, the row of the smallest id (of equal ids, of the smallest
    hash of the text), once where it is repeated.

    Texts link if the SimHashes of their sets of shingles differ in at most distance of 64 bits and total of 128, and the sets'
    Jaccard similarity is at least near, a fraction of whole numbers. Each node's hub is verified first, which joins most of a large group by one
    pair each; then all pairs that are not joined yet, so no link is lost. NULL and wordless texts are one group; a row without
    an id stays where its group has no row with one; an empty table gives no rows.
    """
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), th.alias("th"), F.col(text_col).alias("text"))
    prints = written(set_prints(rows, shingle), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th"))
    classes = written(prints.groupBy("node").agg(F.min("fp").alias("fp"), F.min("more").alias("more"), F.max("n").alias("n"), F.min("th").alias("th"), first.alias("first")), "classes")
    asked = _plan(classes, distance)
    tried = written(meetings(classes, asked, distance, "hubs", total), "hubs")
    sets = sets_of(rows, classes, tried, shingle)
    links = alike(tried, sets, near)
    label = lambda of: F.coalesce("root", of)
    apart = classes.join(components(links), "node", "left").select("node", "fp", "more", label("node").alias("label"))
    links = links.unionByName(alike(written(meetings(written(apart, "labels"), asked, distance, "all", total), "others"), sets, near))
    rooted = classes.join(components(links), "node", "left").groupBy(label("node")).agg(F.min("first").alias("first"))
    keep = written(rooted.select(F.col("first.doc_id").alias("__keep"), F.col("first.th").alias("__keep_th")), "keep")
    marked = docs.withColumn("__th", th)
    kept = marked.join(keep, marked[id_col].eqNullSafe(keep["__keep"]) & (marked["__th"] == keep["__keep_th"]), "left_semi")
    return kept.dropDuplicates([id_col, "__th"]).drop("__th")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
