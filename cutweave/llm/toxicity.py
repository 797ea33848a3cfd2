"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's score is a logistic function of its hashed words and word pairs; a document's is the noisy-or of its sentences'.
Only documents are labelled; the gradient of the document's loss falls on the sentences in proportion to their scores, which
is how the offending ones are found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import table
from .learning import Ftrl, known_fold, labelled_sample, sigmoid, trained
from .words import mix, slices, words_of

BITS = 18
FOLDS, HELD = 5, 0
#: Labelled documents to learn from, about, and bytes of text whose features are held at once.
MOST, SLICE = 12_000, 1 << 21
EPOCHS, ALPHA, L1, L2, START = 10, 0.5, 6.0, 0.01, -5.0
#: Labelled documents in which a word or pair must stand to get a weight: words of a few documents would be learned by heart.
COMMON = 5


def instances(texts: pa.Array):
    """(words, doc of each sentence, its byte span, and for each feature its sentence and its weight's place).

    The features of a sentence are its words without punctuation at their sides, its pairs of words, and the first 3, 4 and 5
    bytes of its words, each as often as it stands there.
    """
    w = words_of(texts)
    begins = w.sentences()
    sentence = np.cumsum(begins) - 1
    start, end = w.stripped()
    real = start < end
    h = np.zeros(len(start), np.uint64)
    h[real] = w.hashes(start[real], end[real])
    pair = real[1:] & real[:-1] & (sentence[1:] == sentence[:-1])
    place = lambda x, kind: (mix(x + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int32)
    s, size, of_word = start[real], (end - start)[real], sentence[real]
    at, of = [place(h[real], 1), place(h[:-1][pair] * np.uint64(3) + h[1:][pair], 2)], [of_word, sentence[1:][pair]]
    head = np.zeros(len(s), np.uint64)
    for k in range(5):
        long = size > k
        head[long] |= w.raw[s[long] + k].astype(np.uint64) << np.uint64(8 * k)
        if k >= 2:
            at.append(place(head[long], k + 1))
            of.append(of_word[long])
    heads = np.flatnonzero(begins)
    tails = np.append(heads[1:], len(begins))[: len(heads)] - 1
    return w, w.doc[heads], np.stack([w.start[heads], w.end[tails]], axis=1), np.concatenate(of), np.concatenate(at)


def noisy_or(p: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    return -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=docs))


def fit(batches) -> bytes:
    """The weights as 32-bit floats, the bias last. Without labelled documents the bias alone speaks."""
    size = 1 << BITS
    held, texts, bags = np.zeros(size, np.int64), [], []
    for batch in batches:
        for part in slices(batch, most=SLICE):
            _, doc, _, of, at = instances(part.column("text"))
            held += np.bincount(np.unique(doc[of] << BITS | at) & (size - 1), minlength=size)
            texts.append(part)
    for part in texts:  # again, now that the common ones are known: the others are never kept
        _, doc, _, of, at = instances(part.column("text"))
        common = held[at] >= COMMON
        of, at = of[common], at[common]
        turn = np.argsort(of, kind="stable")
        of, at = of[turn], at[turn]
        bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
        feats = np.searchsorted(of, bounds)
        for i, y in enumerate(part.column("y").to_pylist()):
            if bounds[i] < bounds[i + 1]:
                s = slice(feats[i], feats[i + 1])
                bags.append((at[s].astype(np.int32), (of[s] - bounds[i]).astype(np.int32), int(bounds[i + 1] - bounds[i]), float(y)))
    # few toxic examples give small sums of gradients, so what a weight must overcome follows their number
    model = Ftrl(size, ALPHA, min(L1, max(0.3, sum(y for *_, y in bags) / 100)), L2)
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(bags)):
            at, of, n, y = bags[k]
            idx, inverse = np.unique(np.append(at, size), return_inverse=True)  # the bias last
            w = model.weights(idx)
            p = sigmoid(np.bincount(of, w[inverse[:-1]], minlength=n) + w[-1] + START)
            bag = max(float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), 1e-9)
            g = p * (-(1 - bag) / bag if y else 1.0)  # by each sentence's score before the logistic function
            model.learn(idx, w, np.append(np.bincount(inverse[:-1], g[of], minlength=len(idx) - 1), g.sum()))
    w = model.weights(np.arange(size + 1))
    w[-1] += START
    return w.astype("<f4").tobytes()


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> bytes:
    """labels(doc_id, y): rows without an id or a label teach nothing."""
    return trained(labelled_sample(docs, labels.filter("doc_id IS NOT NULL AND y IS NOT NULL"), most), fit)


def score(docs: DataFrame, model: bytes, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", details: bool = True) -> DataFrame:
    """doc_id, score, predicted and, with details, worst (the sentence of the highest score), worst_score, offending (sentences at or above the
    threshold, with their scores, in text order) for each row of docs. NULL and wordless texts have score 0 and no sentence."""
    id_type = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)  # the size is fixed by BITS
    found = pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())]))

    def run(batches):
        tokens.release()
        w = np.frombuffer(held.value, "<f4").astype(np.float64)
        for batch in batches:
            for part in slices(batch, most=SLICE):
                words, doc, spans, of, at = instances(part.column("text"))
                p = sigmoid(np.bincount(of, w[at], minlength=len(doc)) + w[-1])
                total = noisy_or(p, doc, part.num_rows)
                if not details:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(total), pa.array((total >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])
                    continue
                text = lambda k: words.text[spans[k, 0] : spans[k, 1]].tobytes().decode()  # noqa: B023, E731
                bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
                best = [a + int(np.argmax(p[a:b])) if a < b else None for a, b in zip(bounds, bounds[1:], strict=False)]
                bad: list[list[dict]] = [[] for _ in best]
                for k in np.flatnonzero(p >= threshold):
                    bad[doc[k]].append({"sentence": text(k), "score": float(p[k])})
                cols = [part.column("doc_id"), pa.array(total), pa.array((total >= threshold).astype(np.int32)), pa.array([None if k is None else text(k) for k in best], pa.string()), pa.array([None if k is None else float(p[k]) for k in best], pa.float64()), pa.array(bad, found)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "score", "predicted", "worst", "worst_score", "offending"])

    schema = f"doc_id {id_type}, score double, predicted int" + ", worst string, worst_score double, offending array<struct<sentence:string,score:double>>" * details
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), known_fold(F.col("doc_id"), FOLDS, HELD)
    labels = table(spark, sf_dir, "labels").filter(~held).select("doc_id", F.col("toxic").alias("y"))
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "worst", "worst_score")
