"""Quality scores: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .learning import Ftrl, known_fold, labelled_sample, sigmoid, trained
from .words import Words, mix, slices, words_of

BITS = 18
FOLDS, HELD = 5, 0
#: Labelled documents to learn from.
MOST = 20_000
EPOCHS, ALPHA, L1, L2 = 4, 0.3, 0.02, 0.1


def _forms(w: Words) -> np.ndarray:
    """A coarse form of each word: classes of its first and last byte, its length, and whether it repeats the word before."""
    kind = np.full(256, 1, np.uint64)
    kind[48:58], kind[128:] = 2, 3
    for b in range(33, 127):
        if not chr(b).isalnum():
            kind[b] = b
    for b in range(65, 91):
        kind[b] = 4
    length = np.minimum(w.end - w.start, 12).astype(np.uint64)
    return kind[w.text[w.start]] * np.uint64(1 << 20) + kind[w.text[w.end - 1]] * np.uint64(1 << 8) + length


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, index, value): the hashed words, word pairs and pairs of word forms of each text, counted and scaled to unit length.

    Text i has index[first[i]:first[i + 1]], distinct and ascending; a text without words has none.
    """
    w = words_of(texts)
    h, form = w.hashes(), _forms(w)
    pair = w.doc[1:] == w.doc[:-1]
    again = (h[1:] == h[:-1]) & pair
    pairs, formed = mix(h[:-1] * np.uint64(3) + h[1:])[pair], mix(form[:-1] * np.uint64(0x10001) + form[1:] + (again.astype(np.uint64) << np.uint64(50)))[pair]
    doc = np.concatenate([w.doc, w.doc[1:][pair], w.doc, w.doc[1:][pair]])
    at = np.concatenate([h, pairs, mix(form + np.uint64(7)), formed]) >> np.uint64(64 - BITS)
    # the kinds keep to quarters of the table, so that a form never shares a weight with a word
    kind = np.repeat(np.arange(4, dtype=np.uint64), [len(h), int(pair.sum()), len(h), int(pair.sum())])
    at = (at >> np.uint64(2)) | (kind << np.uint64(BITS - 2))
    key, count = np.unique((doc.astype(np.uint64) << np.uint64(BITS)) | at, return_counts=True)
    row = (key >> np.uint64(BITS)).astype(np.int64)
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    value = np.sqrt(count.astype(np.float64))
    size = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
    return first, (key & np.uint64((1 << BITS) - 1)).astype(np.int64), value / np.maximum(size, 1e-12)[row]


def fit(batches) -> bytes:
    """The weights as 32-bit floats, the bias last."""
    rows = []
    for batch in batches:
        for part in slices(batch):
            first, index, value = features(part.column("text"))
            bias = np.array([1 << BITS]), np.ones(1)
            for i, y in enumerate(part.column("y").to_pylist()):
                s = slice(first[i], first[i + 1])
                rows.append((np.concatenate([index[s], bias[0]]).astype(np.int32), np.concatenate([value[s], bias[1]]).astype(np.float32), float(y)))
    model = Ftrl(1 << BITS, ALPHA, L1, L2)
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, x, y = rows[k]
            w = model.weights(at)
            model.learn(at, w, (sigmoid(float(w @ x)) - y) * x)
    return model.weights(np.arange((1 << BITS) + 1)).astype("<f4").tobytes()


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> bytes:
    """labels(doc_id, y): rows without an id or a label teach nothing. Without any, all weights are 0 and each score 0.5."""
    return trained(labelled_sample(docs, labels.filter("doc_id IS NOT NULL AND y IS NOT NULL"), most), fit)


def score(docs: DataFrame, model: bytes, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted for each row of docs; NULL and wordless texts get the bias' score."""
    id_type = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)  # the size is fixed by BITS

    def run(batches):
        w = np.frombuffer(held.value, "<f4").astype(np.float64)
        for batch in batches:
            for part in slices(batch):
                first, index, value = features(part.column("text"))
                total = np.concatenate([[0.0], np.cumsum(w[index] * value)])
                p = sigmoid(total[first[1:]] - total[first[:-1]] + w[-1])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), known_fold(F.col("doc_id"), FOLDS, HELD)
    labels = table(spark, sf_dir, "labels").filter(~held).select("doc_id", F.col("quality").alias("y"))
    scored = score(docs, train(docs, labels), 0.3)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")
