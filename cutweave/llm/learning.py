"""A bounded, seeded sample of labelled documents, brought to one task that trains a model, and the updates used there."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens


def labelled_sample(docs: DataFrame, label: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """label(doc_id, y) -> (text, y): the documents of about most labelled ids, at most twice as many, in a fixed order and in one partition.

    The bound is what makes one task fit; ids are chosen by their hash, whatever the size of the input.
    """
    ids = label.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = ids.count()
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30))
    chosen = ids.filter(part < int(min(1.0, most / max(n, 1)) * (1 << 30))).orderBy(part, "doc_id").limit(2 * most)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.select(F.coalesce("text", F.lit("")).alias("text"), "y", F.xxhash64("doc_id", "text").alias("turn")).repartition(1).sortWithinPartitions("turn").select("text", "y")


def trained(sample: DataFrame, fit) -> bytes:
    """fit(batches of (text, y)) -> bytes, run in the task that holds the sample."""
    import pyarrow as pa

    def run(batches):
        tokens.release()
        yield pa.RecordBatch.from_arrays([pa.array([fit(batches)], pa.binary())], ["model"])

    row = sample.mapInArrow(run, "model binary").first()
    return bytes(row["model"]) if row else fit(iter(()))  # a plan without rows has no task


def known_fold(key: Column, folds: int, held: int) -> Column:
    """Whether a row is held out; rows without an id are."""
    return F.coalesce(F.crc32(key.cast("string")) % F.lit(folds) == F.lit(held), F.lit(True))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Follow-the-regularised-leader: sums of gradients and of their squares; weights follow from them, many exactly 0."""

    def __init__(self, size: int, alpha: float, l1: float, l2: float, beta: float = 1.0):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias
        self.alpha, self.l1, self.l2, self.beta = alpha, l1, l2, beta

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, w: np.ndarray, g: np.ndarray) -> None:
        """One step at distinct places whose weights are w, by the gradient g."""
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g
