"""Pairs of 64-bit fingerprints within a Hamming distance, by the generalised pigeonhole principle.

Bits fall into partitions; with thresholds that sum to distance - partitions + 1, any pair within the distance is within its
threshold in one partition at least. Correlated bits share a partition, and a dynamic program allots the thresholds by the
candidates they are estimated to give. Each fingerprint is filed under its bits in a partition and probes the values within the
threshold; whatever meets is verified, filed against probing.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BITS = 64
#: What a candidate costs beside a probe in the plan: a probe is a row to move and sort, a candidate two bit operations.
CANDIDATE_COST = 0.005
#: Comparisons that one task makes under one key, about; keys with more are cut into cells.
CELL_PAIRS = 1 << 31
#: Partners of a fingerprint from which on they are compared by themselves, and pairs that are compared at once before.
ALONE, AT_ONCE = 512, 1 << 20


def bit_counts(fps: DataFrame) -> np.ndarray:
    """64 x 64: in how many fingerprints both bits are set. 64 rows reach the driver."""

    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            bits = np.unpackbits(np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS), pa.int32()), *[pa.array(total[:, j]) for j in range(BITS)]], ["bit", *[f"c{j}" for j in range(BITS)]])

    cols = [f"c{j}" for j in range(BITS)]
    sums = fps.select("fp").mapInArrow(run, "bit int, " + ", ".join(f"{c} long" for c in cols)).groupBy("bit").agg(*[F.sum(c).alias(c) for c in cols])
    out = np.zeros((BITS, BITS))
    for r in sums.collect():
        out[r["bit"]] = [r[c] for c in cols]
    return out


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of the bits: each begins with the free bit of most correlation and takes the free bits most correlated to it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in free if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def within(group: list[int], p: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints differ in at most e bits of the group, for e = 0, 1, ..., from the bits' frequencies."""
    at = np.array([1.0])
    for b in group:
        q = 2 * p[b] * (1 - p[b])
        at = np.append(at * (1 - q), 0) + np.append(0, at * q)
    return np.cumsum(at)


def allot(groups: list[list[int]], p: np.ndarray, n: int, distance: int) -> tuple[float, list[int]]:
    """(cost, thresholds): the dynamic program over partitions and what is left of the sum. A threshold of -1 asks nothing."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        chance, nxt = within(group, p), {}
        for used, (cost, chosen) in best.items():
            for e in range(-1, min(distance, len(group)) + 1):
                more = 0.0 if e < 0 else n * (1 + sum(comb(len(group), d) for d in range(1, e + 1)) / 2) + CANDIDATE_COST * n * n / 2 * float(chance[e])
                if used + e not in nxt or cost + more < nxt[used + e][0]:
                    nxt[used + e] = (cost + more, [*chosen, e])
        best = nxt
    return best[distance - len(groups) + 1]


def plan(both: np.ndarray, n: int, distance: int) -> list[tuple[int, int, list[int]]]:
    """(mask, threshold, bits) of each partition that is asked, for the number of partitions of least cost; none for distance 0."""
    p = np.diag(both) / max(n, 1)
    found = []
    for parts in range(2, distance + 2):
        groups = group_bits(both, n, parts)
        cost, limits = allot(groups, p, n, distance)
        found.append((cost, parts, [(sum(1 << b for b in g), e, g) for g, e in zip(groups, limits, strict=True) if e >= 0]))
    return min(found)[2] if found else []


def flips(bits: list[int], most: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for d in range(1, most + 1) for c in combinations(bits, d)], np.uint64)


def places(fp: np.ndarray, mask: int, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, index into fp, whether it probes) of every row that one partition gives. Of two values, the smaller probes the larger."""
    own = fp & np.uint64(mask)
    at, other = np.nonzero((own[:, None] ^ around[None, :]) > own[:, None])
    return np.concatenate([own, own[at] ^ around[other]]), np.concatenate([np.arange(len(fp)), at]), np.repeat([0, 1], [len(fp), len(at)]).astype(np.int8)


def _slices(batches, columns: int):
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            yield [b.column(c).to_numpy(zero_copy_only=False)[at : at + 4096] for c in range(columns)]


def partners(fp: np.ndarray, filed: np.ndarray, start: np.ndarray, stop: np.ndarray, distance: int):
    """(i, j) arrays of rows within distance: i is a filed row, j one of start to stop that goes with it."""
    tail = np.maximum(stop - start, 0)
    for k in np.flatnonzero(tail > ALONE).tolist():
        j = start[k] + np.flatnonzero(np.bitwise_count(fp[start[k] : stop[k]] ^ fp[filed[k]]) <= distance)
        yield np.full(len(j), filed[k]), j
    few = np.flatnonzero((tail > 0) & (tail <= ALONE))
    ends = np.cumsum(tail[few])
    for at in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
        some = few[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + AT_ONCE, "right")]
        n = tail[some]
        i, j = np.repeat(filed[some], n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[some], n)
        near = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        yield i[near], j[near]


def joined(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row of the pairs with the smallest that pairs connect it to: as connected as the pairs, and no more than the rows."""
    rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = at[: len(i)], at[len(i) :]
    root = np.arange(len(rows))
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if np.array_equal(low, root):
            return rows, rows[root]
        root = low


def hubs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row of the pairs with the one of its partners that has most: of a group of copies, what they are copies of."""
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    links = np.bincount(a) if len(a) else a
    order = np.lexsort((b, -links[b], a))
    first = order[np.flatnonzero(np.diff(a[order], prepend=-1))]
    return a[first], b[first]


def meetings(nodes: DataFrame, asked: list[tuple[int, int, list[int]]], distance: int, give: str = "joined", total: int | None = None) -> DataFrame:
    """nodes(node, fp[, more][, label]) -> distinct (u, v) of nodes within distance. With more, 64 further bits, fp and more together
    must differ in at most total bits; with label, only nodes whose labels differ count.

    give says which: all pairs; hubs, one partner for each node that has any; joined, pairs of nodes that chains of links
    connect, at most one for each row. No task holds more than the rows that one key or cell files.
    """
    if not asked:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    probes = [(i, mask, flips(bits, e)) for i, (mask, e, bits) in enumerate(asked)]
    carried = ["node", "fp", *[c for c in ("more", "label") if c in nodes.columns]]

    def load(batches):
        for (fp,) in _slices(batches, 1):
            for i, mask, around in probes:
                key, _, probe = places(fp.view(np.uint64), mask, around)
                keys, at = np.unique(key, return_inverse=True)
                filed = np.bincount(at, probe == 0, len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), i, np.int8)), pa.array(keys.view(np.int64)), pa.array(filed), pa.array(np.bincount(at, minlength=len(keys)))], ["part", "key", "filed", "rows"])

    def file(batches):
        for cols in _slices(batches, len(carried)):
            for i, mask, around in probes:
                key, at, probe = places(cols[1].view(np.uint64), mask, around)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), i, np.int8)), pa.array(key.view(np.int64)), pa.array(np.zeros(len(key), np.int32)), pa.array(probe), *[pa.array(c[at]) for c in cols]], ["part", "key", "cell", "probe", *carried])

    def meet(batches):
        held = None
        for b in batches:
            new = [b.column(c).to_numpy(zero_copy_only=False) for c in range(b.num_columns)]
            fresh, cols = (0, new) if held is None else (len(held[0]), [np.concatenate(c) for c in zip(held, new, strict=True)])
            part, key, cell, probe = cols[:4]
            by = dict(zip(carried, cols[4:], strict=True))
            node, fp = by["node"], by["fp"].view(np.uint64)
            if not len(part):
                continue
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0) | (np.diff(cell) != 0)) + 1, [len(part)]])
            stop = np.repeat(cuts[1:], np.diff(cuts))
            filed = np.flatnonzero(probe == 0)
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for i, j in partners(fp, filed, np.maximum(filed + 1, fresh), stop[filed], distance):
                real = node[i] != node[j]
                if "label" in by:
                    real &= by["label"][i] != by["label"][j]
                if total is not None:
                    real &= np.bitwise_count(fp[i] ^ fp[j]) + np.bitwise_count((by["more"][i] ^ by["more"][j]).view(np.uint64)) <= total
                found.append((i[real], j[real]))
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(i):
                u, v = joined(i, j) if give == "joined" else hubs(i, j) if give == "hubs" else (i, j)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[u], node[v])), pa.array(np.maximum(node[u], node[v]))], ["u", "v"])
            held = [c[filed[filed >= cuts[-2]]] for c in cols]  # what may meet the rows that follow

    types = ", ".join(f"{c} long" for c in carried)
    rows = nodes.select(*carried).mapInArrow(file, f"part byte, key long, cell int, probe byte, {types}")
    loads = nodes.select("fp").mapInArrow(load, "part byte, key long, filed long, rows long").groupBy("part", "key").agg(F.sum("filed").alias("filed"), F.sum("rows").alias("rows"))
    side = F.ceil(F.sqrt(F.col("filed") / CELL_PAIRS * F.col("rows"))).cast("int")
    heavy = written(loads.withColumn("side", side).filter("side > 1").select("part", "key", "side"), "heavy")
    if not heavy.isEmpty():  # else there is nothing to join
        deal = lambda seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col("side")).cast("int")
        one = lambda cell, probe: F.struct(cell.alias("cell"), F.lit(probe).cast("byte").alias("probe"))
        line = F.sequence(F.lit(0), F.col("side") - 1)
        as_filed = F.when(F.col("probe") == 0, F.transform(line, lambda b: one(deal(1) * F.col("side") + b, 0))).otherwise(F.array().cast("array<struct<cell:int,probe:tinyint>>"))
        as_other = F.transform(line, lambda a: one(a * F.col("side") + deal(2), 1))
        cells = F.when(F.col("side").isNull(), F.array(one(F.lit(0), 0))).otherwise(F.concat(as_filed, as_other))
        spread = rows.join(heavy, ["part", "key"], "left").select("*", F.explode(cells).alias("to"))
        rows = spread.select("part", "key", F.col("to.cell").alias("cell"), F.when(F.col("side").isNull(), F.col("probe")).otherwise(F.col("to.probe")).alias("probe"), *carried)
    return rows.repartition("part", "key", "cell").sortWithinPartitions("part", "key", "cell", "probe").mapInArrow(meet, "u long, v long").filter("u <> v").distinct()
