"""Embedding whitening by a singular value decomposition of the centred vectors.

Each task folds its centred rows, block by block, into the triangular factor R of a QR decomposition; factors are stacked and
decomposed again in a tree of FAN at a time, so no task sees more than FAN factors. Plane rotations make R's columns orthogonal
(one-sided Jacobi); the rotations, multiplied up, are the components, and the columns' lengths over sqrt(n) the standard deviations.
The driver holds FAN factors of dims x dims at most, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

#: Components that are returned.
COMPONENTS = 16
#: Factors that are stacked at a time.
FAN = 16
#: Rows that are folded into a factor at a time.
ROWS = 4096
#: Deviations below this part of the largest count as none: rounding alone is about as large.
NONE = 1e-11
#: Entries beyond this (after scaling) count as this, so that all sums stay exact.
MOST = 1 << 52


def vectors(df: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """vec_id, x (array of long) of the rows whose vectors are whole and finite."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"))
    whole = F.coalesce(F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))), F.lit(False))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST)))) + F.lit(shift))
    return rows.filter(whole).select("vec_id", x.alias("x"))


def usual_length(df: DataFrame) -> int:
    """The most frequent length of x, the longer one where two are; 0 for an empty table."""
    row = df.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return row["dims"] if row else 0


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An array column as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def blocks(batches, dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield matrix(batch.column("x").slice(a, ROWS), dims)


def sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows and each dimension's exact sum."""

    def run(batches):
        n, total = 0, [0] * dims
        for x in blocks(batches, dims):
            n += len(x)
            # halves, so that no partial sum leaves 64 bits
            high, low = (x >> 26).sum(0).tolist(), (x & (1 << 26) - 1).sum(0).tolist()
            total = [t + (h << 26) + lo for t, h, lo in zip(total, high, low, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([t >> 40 for t in total], pa.int64()), pa.array([t & (1 << 40) - 1 for t in total], pa.int64())], ["dim", "n", "high", "low"])

    rows = fit.select("x").mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("dim").collect()
    return (rows[0]["n"], [(r["high"] << 40) + r["low"] for r in rows]) if rows else (0, [0] * dims)


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total: integers of 64 bits where they fit, Python's else."""
    most = max(int(np.abs(x).max(initial=0)) * n, max((abs(t) for t in total), default=0))
    if most < 1 << 61:
        return x * n - np.array(total, np.int64)
    return x.astype(object) * n - np.array(total, object)


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x minus the mean, rounded once."""
    return deviations(x, n, total).astype(np.float64) / n


def fold(parts: Iterator[np.ndarray], dims: int) -> np.ndarray:
    """R of all parts stacked."""
    r = np.zeros((0, dims))
    for part in parts:
        r = np.linalg.qr(np.vstack([r, part]), mode="r")
    return r


def triangular(fit: DataFrame, dims: int, n: int, total: list[int], fan: int = FAN) -> np.ndarray:
    """R with R'R = the centred rows' products."""

    def first(batches):
        r = fold((centred(x, n, total) for x in blocks(batches, dims)), dims)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], ["part", "r"])

    def again(key, rows):
        r = fold((np.asarray(flat, np.float64).reshape(-1, dims) for flat in rows.column("r").to_numpy(zero_copy_only=False)), dims)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    factors = written(fit.select("x").mapInArrow(first, "part long, r array<double>"), "factors")
    while factors.count() > fan:
        groups = factors.groupBy(F.floor(F.col("part") / fan).alias("group"))
        factors = written(groups.applyInArrow(again, "part long, r array<double>"), "factors")
    return fold((np.array(row["r"], np.float64).reshape(-1, dims) for row in sorted(factors.collect())), dims)


def rotations(dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which each pair of columns meets once."""
    ring, out = list(range(dims + dims % 2)), []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :]), strict=True) if a < dims and b < dims]
        out.append((np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def jacobi(r: np.ndarray, sweeps: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Singular values in falling order and right singular vectors (columns) of r: its columns are rotated in pairs, all pairs of a
    round at once, until all are orthogonal to working precision."""
    dims = r.shape[1]
    both = np.vstack([r, np.eye(dims)])  # what is done to the columns is done to the unit matrix
    size, eps, rounds = len(r), np.finfo(float).eps, rotations(dims)
    floor = (eps * np.linalg.norm(r)) ** 2
    for _ in range(sweeps):
        turned = False
        for p, q in rounds:
            a, b = both[:size, p], both[:size, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(gamma) > np.maximum(4 * eps * np.sqrt(alpha * beta), floor)
            if not turn.any():
                continue
            turned = True
            p, q, gamma = p[turn], q[turn], gamma[turn]
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            left, right = both[:, p], both[:, q]
            both[:, p], both[:, q] = c * left - c * t * right, c * t * left + c * right
        if not turned:
            break
    else:
        raise ArithmeticError("columns did not become orthogonal")
    lengths = np.sqrt((both[:size] ** 2).sum(0))
    order = np.argsort(-lengths, kind="stable")
    return lengths[order], both[size:, order]


def identity_error(fit: DataFrame, n: int, total: list[int], turn: np.ndarray) -> float:
    """The largest entry of the covariance of centred(x) @ turn minus the unit matrix: each task centres its own rows, then what the
    tasks' means add is summed by pairs of components."""
    dims, k = turn.shape
    if not k:
        return 0.0
    i, j = np.triu_indices(k)

    def run(batches):
        rows, mean, product = 0, np.zeros(k), np.zeros((k, k))
        for x in blocks(batches, dims):
            w = centred(x, n, total) @ turn
            m, own = len(w), w.mean(0)
            gap = own - mean
            product += (w - own).T @ (w - own) + np.outer(gap, gap) * (rows * m / (rows + m))
            mean, rows = mean + gap * (m / (rows + m)), rows + m
        if rows:
            cols = [i, j, (product + rows * np.outer(mean, mean))[i, j], np.where(i == j, rows * mean[i], 0.0)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(cols[2]), pa.array(cols[3])], ["i", "j", "product", "part"])

    rows = fit.select("x").mapInArrow(run, "i int, j int, product double, part double").groupBy("i", "j").agg(F.sum("product").alias("product"), F.sum("part").alias("part")).collect()
    mean = {r["i"]: r["part"] / n for r in rows if r["i"] == r["j"]}
    return max(abs(r["product"] / n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in rows)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, shift: int = 1_000_000, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained, identity_error for each row with a whole vector.

    x = floor(scale * entry) + shift. The fit list has each distinct x vector once. Rows whose vector is NULL or holds NULL or
    non-finite entries are dropped; so are vectors of another length than the most frequent one (the longer of two), which lie in
    another space. Scaled entries beyond 2^52 count as 2^52. Where there are fewer dimensions than components, each dimension gives
    one; a component without variance (one vector, equal vectors, dependent dimensions) has whitened NULL and explained 0, and does
    not count in identity_error. Rows that share an id, or have none, stand for themselves; an empty table, or vectors of no
    entries, give no rows. Further columns, of whatever name, are left out.
    """
    spark, id_type = df.sparkSession, df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = vectors(df, id_col, vec_col, scale, shift)
    dims = usual_length(rows)
    if not dims:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == dims)
    fit = written(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    n, total = sums(fit, dims)
    lengths, axes = jacobi(triangular(fit, dims, n, total))
    k = min(components, dims)
    spread = lengths[:k] / np.sqrt(n)
    some = int((lengths[:k] > NONE * lengths[0]).sum()) if lengths[0] > 0 else 0
    whole = float((lengths**2).sum())
    explained = [float(s * s / whole) if c < some else 0.0 for c, s in enumerate(lengths[:k])]
    turn = axes[:, :some] / spread[:some]
    error = identity_error(fit, n, total, turn)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                away = deviations(matrix(part.column("x"), dims), n, total)
                m = part.num_rows
                small = away.dtype != object and int(np.abs(away).max(initial=0)) ** 2 * dims < 1 << 63
                far = (away * away).sum(1).tolist() if small else [sum(int(d) ** 2 for d in row) for row in away.tolist()]
                white = np.full((m, k), np.nan)
                white[:, :some] = (away.astype(np.float64) / n) @ turn
                flat = pa.array(white.ravel(), mask=np.tile(np.arange(k) >= some, m))
                again = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                        pa.array([None if f >= 10**38 else f for f in far], pa.decimal128(38, 0)).take(pa.array(again)), flat, pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))
