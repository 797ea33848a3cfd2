"""Benchmark decontamination: an FM-index for each shard of the training texts, searched backwards for all windows of the items.

A shard is what a task holds at a time: texts of some megabytes. Words that no item holds cannot be part of a window, so a run of
them is one symbol. Windows are found as ranges of suffixes, their places by sampled positions, and overlapping places are merged
to spans. Nothing is shuffled: a document's row is made where it is read. Items come in blocks of at most BLOCK words, each sent to
all tasks; the size of a block is its bound, and further blocks are searched in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .fmindex import FMIndex
from .runs import ALNUM, runs_of
from .words import slices

#: Words of a window.
WINDOW = 10
#: Bytes of texts in a shard; a longer text is alone in one.
SHARD = 1 << 22
#: Symbols of one index; longer shards are indexed in parts that overlap by a window.
PART = 1 << 21
#: Words of the items that are searched together; the largest item may be above it.
BLOCK = 1 << 21


@dataclass
class Block:
    """Windows of some items. vocabulary: their words; phrases: ids (from 2) at the right end of each row; lengths; of: for each
    window its items, from bound[i] to bound[i + 1]; names: the items' ids as strings."""

    vocabulary: pa.Array
    phrases: np.ndarray
    lengths: np.ndarray
    of: np.ndarray
    bound: np.ndarray
    names: np.ndarray


def block_of(items: list[tuple[str | None, str]], window: int) -> Block:
    """The distinct windows of items (id, text)."""
    names = sorted({name for name, _ in items if name is not None})
    number = {name: i for i, name in enumerate(names)} | {None: -1}
    runs = runs_of(pa.array([t for _, t in items], pa.large_string()), ALNUM)
    coded = runs.strings().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 2
    rows, owners = [], []
    for i, (name, _) in enumerate(items):
        own = codes[runs.first[i] : runs.first[i + 1]]
        if len(own):
            n = min(window, len(own))
            cut = np.lib.stride_tricks.sliding_window_view(own, n)
            rows.append(np.hstack([np.zeros((len(cut), window - n), np.int64), cut]))
            owners.append(np.full(len(cut), number[name]))
    if not rows:
        return Block(coded.dictionary, np.zeros((0, window), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.array(names, object))
    phrases, which = np.unique(np.vstack(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), np.concatenate(owners)], 1), axis=0)
    pairs = pairs[pairs[:, 1] >= 0]  # an item without an id is searched for, not named
    return Block(coded.dictionary, phrases, (phrases > 0).sum(1), pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(phrases) + 1)), np.array(names, object))


def blocks(items: DataFrame, id_col: str, text_col: str, window: int, most: int) -> Iterator[Block]:
    """Items one after the other, in blocks of about most words (a text of n bytes has n / 2 + 1 words at most)."""
    held, words = [], 0
    wanted = items.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    for row in wanted.distinct().toLocalIterator():
        size = len(row["text"].encode()) // 2 + 1
        if held and words + size > most:
            yield block_of(held, window)
            held, words = [], 0
        held.append((row["name"], row["text"]))
        words += size
    yield block_of(held, window)


def hits(codes: np.ndarray, first: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """codes: a symbol (0 for words of no item) for each word of a shard; first: each document's first word, and their number.

    Returns for each word whether a window covers it, and the distinct (document, window) pairs.
    """
    n, docs = len(codes), len(first) - 1
    at = np.insert(np.arange(n), first[:-1], -1)  # a mark before each document
    text = np.where(at < 0, 1, np.maximum(codes[at] if n else np.zeros(len(at), np.int64), 1))
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] > 1) | (text[:-1] > 1)
    text, at = text[keep], at[keep]
    change, pairs, width = np.zeros(n + 1, np.int64), [np.zeros(0, np.int64)], block.phrases.shape[1]
    if len(block.phrases) and (text > 1).any():
        for a in range(0, len(text), PART):
            index = FMIndex(text[a : a + PART + width - 1], len(block.vocabulary) + 2)
            for phrase, place in index.occurrences(block.phrases, block.lengths):
                word = at[place + a]
                change += np.bincount(word, minlength=n + 1) - np.bincount(word + block.lengths[phrase], minlength=n + 1)
                pairs.append(np.unique((np.searchsorted(first, word, "right") - 1) * len(block.phrases) + phrase))
    pair = np.unique(np.concatenate(pairs))
    return np.cumsum(change[:n]) > 0, np.stack([pair // max(len(block.phrases), 1), pair % max(len(block.phrases), 1)], 1) if docs else np.zeros((0, 2), np.int64)


def _names(pairs: np.ndarray, block: Block, docs: int) -> list[set[str]]:
    found: list[set[str]] = [set() for _ in range(docs)]
    doc, phrase = pairs[:, 0], pairs[:, 1]
    many = block.bound[phrase + 1] - block.bound[phrase]
    turn = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    item = block.of[np.repeat(block.bound[phrase], many) + turn]
    for key in np.unique(np.repeat(doc, many) * max(len(block.names), 1) + item).tolist():
        found[key // len(block.names)].add(block.names[key % len(block.names)])
    return found


def search(texts: pa.Array, held: list[Block]) -> list[tuple[int, int, list[tuple[int, int]], list[str]]]:
    """For each text: its words, its words hit, the spans of these in code points, and the items' ids as sorted strings."""
    runs = runs_of(texts, ALNUM)
    words, covered, names = runs.strings(), np.zeros(len(runs.start), bool), [set() for _ in range(len(texts))]
    for block in held:
        codes = pc.index_in(words, value_set=block.vocabulary).fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int64) + 2
        hit, pairs = hits(codes, runs.first, block)
        covered |= hit
        for own, more in zip(names, _names(pairs, block, len(texts)), strict=True):
            own |= more
    out, total = [], np.concatenate([[0], np.cumsum(covered)])
    for i in range(len(texts)):
        a, b = int(runs.first[i]), int(runs.first[i + 1])
        spans, n_hit = [], int(total[b] - total[a])
        if n_hit:
            own = covered[a:b]
            begin = a + np.flatnonzero(own & ~np.concatenate([[False], own[:-1]]))
            end = a + np.flatnonzero(own & ~np.concatenate([own[1:], [False]]))
            points = np.concatenate([[0], np.cumsum((runs.raw[runs.text[i] : runs.text[i + 1]] & 0xC0) != 0x80)])
            spans = list(zip(points[runs.start[begin] - runs.text[i]].tolist(), points[runs.end[end] - runs.text[i]].tolist(), strict=True))
        out.append((b - a, n_hit, spans, sorted(names[i])))
    return out


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without its spans."""
    if text is None or not spans:
        return text
    edges = [0, *[p for s in spans for p in s], len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, spans (start, end in code points, the end excluded), items (ids as strings, sorted as strings) for
    each row of docs, in its order of reading; with texts also cleaned, the text without the spans.

    Words are runs of ASCII letters and digits and of anything that is not ASCII; A-Z are lower-cased. A window is so many words of
    an item in a row; an item of fewer words, but not none, is one window. NULL and empty texts have no words and no hits (cleaned
    stays as it was); NULL and empty items have no windows; no items at all give no hits. Rows that share an id, or have none, stand
    for themselves; items that share an id count as one, and items without an id hit words but are not named. Further columns, of
    whatever name, are left out.
    """
    session = docs.sparkSession.sparkContext
    held = [session.broadcast(b) for b in blocks(items, item_id_col, item_text_col, window, block_words)]  # each bounded by block_words
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for some in slices(batch, "text", SHARD):
                found = search(some.column("text"), [b.value for b in held])
                cols = [
                    some.column("doc_id"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in f[2]] for f in found], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([f[3] for f in found], pa.list_(pa.string())),
                ]
                names = ["doc_id", "n_words", "n_hit", "spans", "items"]
                if texts:
                    cols.append(pa.array([cut(t, f[2]) for t, f in zip(some.column("text").to_pylist(), found, strict=True)], pa.large_string()).cast(pa.string()))
                    names.append("cleaned")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {id_type}, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>" + ", cleaned string" * texts
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def op12_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT p.doc_id, p.i, p.n, w.item_id FROM places p JOIN windows w ON p.n = w.n AND p.phrase = w.phrase
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
