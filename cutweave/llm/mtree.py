"""Exact top-k by inner product with M-trees.

The largest inner products of a query are the smallest distances once each vector x is lengthened by sqrt(M^2 - |x|^2), M being
the largest norm of all, and the query by 0: d^2 = |q|^2 + M^2 - 2 q.x. So metric trees apply. Rows are dealt to blocks of
similar vectors, each block is one tree of pages: an inner node holds routing vectors with covering radii and distances to their
parent's, a leaf holds vectors with distances to theirs. A search opens the page with the least bound first and skips, by the
stored distances, entries whose own distance need not be computed. The trees' own routers, with their covering radii, are the
level above: a query goes to the nearest tree first, and then only to those whose bound its k-th score does not rule out.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

SCALE = 1024
K = 10
LEAF, FANOUT = 128, 16
#: Rows of a tree, about; queries that are searched together.
TREE_ROWS, QUERY_GROUP = 1 << 14, 4096
#: Allowance for rounding in distances, relative to the largest: the root of what a double loses of its square.
SLACK = 1e-7


def scaled(vector: Column) -> Column:
    """floor(1024 x) of each component, as doubles that hold integers; NULL where a component is NULL or not finite, or the vector is."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double")))


def _products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while every partial sum stays below 2^53, else in 64-bit integers (top_k refuses more)."""
    if rows.shape[1] * np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) < 2.0**53:
        return (rows @ q).astype(np.int64)
    return rows.astype(np.int64) @ q.astype(np.int64)


class Tree:
    """An M-tree over the rows of one block, built from the top by pivots."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, most: float, dim: int):
        """most: the square of the largest norm of all rows of the table."""
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.most = ids[order], rows[order], most
        self.lift = np.sqrt(np.maximum(most - (self.rows**2).sum(axis=1), 0.0))
        self.nodes: list[tuple] = []
        self.root = self._grow(np.arange(len(ids)), None)
        self.router = self._middle()
        self.radius = float(self._gaps(np.arange(len(ids)), self.router).max())

    def _middle(self) -> int:
        """The row nearest to the mean: what stands for the tree in the level above."""
        return int(((self.rows - self.rows.mean(axis=0)) ** 2).sum(axis=1).argmin())

    def _gaps(self, at: np.ndarray, centre: int) -> np.ndarray:
        d2 = ((self.rows[at] - self.rows[centre]) ** 2).sum(axis=1) + (self.lift[at] - self.lift[centre]) ** 2
        return np.sqrt(d2)

    def _grow(self, at: np.ndarray, parent: int | None) -> int:
        to_parent = self._gaps(at, parent) if parent is not None else np.full(len(at), np.nan)
        pivots: list[int] = []
        if len(at) > LEAF:
            gap = np.full(len(at), np.inf)  # each next pivot is the vector farthest from those before it
            while len(pivots) < FANOUT:
                far = int(at[np.argmax(gap)]) if pivots else int(at[0])
                if pivots and gap.max() == 0:
                    break
                pivots.append(far)
                gap = np.minimum(gap, self._gaps(at, far))
        if len(pivots) < 2:  # small, or all alike
            self.nodes.append(("leaf", at, to_parent))
            return len(self.nodes) - 1
        gaps = np.stack([self._gaps(at, p) for p in pivots])
        near = gaps.argmin(axis=0)
        entries = []
        for j, p in enumerate(pivots):
            mine = at[near == j]
            if len(mine):
                # a group that took nearly all is cut in half by distance, so that depth stays a logarithm
                halves = [mine] if len(mine) <= 0.9 * len(at) else np.array_split(mine[np.argsort(gaps[j][near == j], kind="stable")], 2)
                entries += [(p, float(self._gaps(h, p).max()), self._grow(h, p)) for h in halves]
        routers = np.array([e[0] for e in entries])
        own = self._gaps(routers, parent) if parent is not None else np.full(len(routers), np.nan)
        self.nodes.append(("inner", routers, np.array([e[1] for e in entries]), own, [e[2] for e in entries]))
        return len(self.nodes) - 1

    def search(self, q: np.ndarray, own: int, k: int, stats: dict | None = None, least: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, id) of a query, higher scores and then smaller ids first; the row with id own takes no part. Only
        scores of at least least matter, where that is given."""
        norm = float((q**2).sum())
        eps = SLACK * (np.sqrt(norm) + np.sqrt(self.most) + 1)
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        limit = np.inf if least is None else np.sqrt(max(norm + self.most - 2.0 * least, 0.0)) + eps

        def gap(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if stats is not None:
                stats["computed"] = stats.get("computed", 0) + len(at)
            dot = _products(self.rows[at], q)
            return dot, np.sqrt(np.maximum(norm + self.most - 2.0 * dot, 0.0))

        queue: list[tuple[float, int, float]] = [(0.0, self.root, np.nan)]
        while queue:
            bound, node, from_parent = heapq.heappop(queue)
            if bound > limit:
                break
            page = self.nodes[node]
            if page[0] == "leaf":
                at, to_parent = page[1], page[2]
                if np.isfinite(limit) and not np.isnan(from_parent):
                    at = at[np.abs(from_parent - to_parent) <= limit]
                if not len(at):
                    continue
                dot, _ = gap(at)
                if len(best) == k:
                    ok = dot >= best[0][0]
                    at, dot = at[ok], dot[ok]
                for score, i in zip(dot.tolist(), self.ids[at].tolist(), strict=True):
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                if len(best) == k:
                    limit = min(limit, np.sqrt(max(norm + self.most - 2.0 * best[0][0], 0.0)) + eps)
            else:
                _, routers, radii, own_gap, children = page
                keep = np.arange(len(routers))
                if np.isfinite(limit) and not np.isnan(from_parent):
                    keep = keep[np.abs(from_parent - own_gap) - radii <= limit]
                if len(keep):
                    _, d = gap(routers[keep])
                    for j, dist, low in zip(keep.tolist(), d.tolist(), np.maximum(d - radii[keep] - eps, 0.0).tolist(), strict=True):
                        if low <= limit:
                            heapq.heappush(queue, (low, children[j], dist))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def bounds(routers: pd.DataFrame, q: np.ndarray, most: float, dim: int) -> np.ndarray:
    """queries x routers: the least distance that a row under each router can have to each query."""
    centre, norm = _matrix(routers["centre"], dim), (q**2).sum(axis=1)
    d = np.sqrt(np.maximum(norm[:, None] + most - 2.0 * (q @ centre.T), 0.0))
    return np.maximum(d - routers["radius"].to_numpy()[None, :] - SLACK * (np.sqrt(norm)[:, None] + np.sqrt(most) + 1), 0.0)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", tree_rows: int = TREE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k rows of highest integer inner product, without its own id.

    vectors and queries have an id and a vector. Rows whose id is NULL, or whose vector is NULL or holds NULL or non-finite
    components, take no part. Shorter vectors count as filled up with zeros. Ties go to the smaller id; rows that share an id
    are candidates each, and ties among them stay apart by rank alone. Repeated queries
    count once; queries that share an id alone fill one list together. Without rows or queries there is no result. Vectors whose
    inner products may pass 64 bits are refused.
    """
    clean = lambda df: df.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col)).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    rows = written(clean(vectors), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(F.count("*"), F.max(square), F.max(F.size("v"))).first()
    asked = written(clean(queries).dropDuplicates(["id", "v"]), "queries")
    wanted = asked.agg(F.count("*"), F.max(square), F.max(F.size("v"))).first()
    if not facts[0] or not wanted[0]:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    most, dim = float(facts[1] or 0.0), max(facts[2] or 0, wanted[2] or 0, 1)
    if max(most, float(wanted[1] or 0.0)) >= 2.0**62:
        raise ValueError("vectors are so long that inner products of their scaled components may pass 64 bits")
    blocks = -(-facts[0] // tree_rows)
    # blocks of similar vectors: the signs along a few seeded directions, then an even deal within each
    signs = max(0, (blocks - 1).bit_length())
    rng = np.random.default_rng(11)
    sides = [F.when(F.aggregate(F.zip_with("v", F.array(*[F.lit(float(x)) for x in rng.choice([-1.0, 1.0], dim)]), lambda a, b: F.coalesce(a, F.lit(0.0)) * F.coalesce(b, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x) > 0, 1 << j).otherwise(0) for j in range(signs)]
    celled = written(rows.withColumn("cell", sum(sides, F.lit(0))), "cells")
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / tree_rows).alias("parts"))
    dealt = celled.join(parts, "cell").select("id", "v", F.concat_ws("-", "cell", F.pmod(F.xxhash64("id"), "parts")).alias("block"))

    def build(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(df["id"].to_numpy(np.int64), _matrix(df["v"], dim), most, dim)
        return pd.DataFrame({"block": [key[0]], "centre": [tree.rows[tree.router].tolist()], "radius": [tree.radius], "tree": [pickle.dumps(tree, protocol=5)]})

    trees = written(dealt.groupBy("block").applyInPandas(build, "block string, centre array<double>, radius double, tree binary"), "trees")
    groups = -(-wanted[0] // QUERY_GROUP)
    asked = asked.withColumn("q_group", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(groups)).cast("int"))
    # the level above the trees, in chunks: every group of queries meets every chunk, but only bounds are computed there
    chunk = F.pmod(F.xxhash64("block"), F.lit(-(-2 * blocks // QUERY_GROUP))).cast("int")
    routers = trees.select("block", "centre", "radius", chunk.alias("chunk")).withColumn("q_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    chunks = F.explode(F.sequence(F.lit(0), F.lit(-(-2 * blocks // QUERY_GROUP) - 1)))

    def nearest(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["id", "v", "q_group", "block", "bound"])
        low = bounds(left, _matrix(right["v"], dim), most, dim)
        at = low.argmin(axis=1)
        return right[["id", "v", "q_group"]].assign(block=left["block"].to_numpy()[at], bound=low[np.arange(len(right)), at])

    at_chunks = lambda df: df.withColumn("chunk", chunks).groupBy("q_group", "chunk")
    sent = "id long, v array<double>, q_group int, block string"
    near = routers.groupBy("q_group", "chunk").cogroup(at_chunks(asked)).applyInPandas(nearest, f"{sent}, bound double")
    home = near.groupBy("id", "v", "q_group").agg(F.min(F.struct("bound", "block"))["block"].alias("block"))

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            tree = pickle.loads(left["tree"].iloc[0])
            least = right["least"] if "least" in right else [None] * len(right)
            for own, q, low in zip(right["id"].tolist(), _matrix(right["v"], dim), least, strict=True):
                out += [(own, i, s) for s, i in tree.search(q, own, k, least=None if low is None or pd.isna(low) else int(low))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def searched(pairs: DataFrame) -> DataFrame:
        pairs = pairs.withColumnsRenamed({"block": "p_block", "q_group": "p_group"})
        asked_of = pairs.select(F.col("p_block").alias("block"), F.col("p_group").alias("group")).distinct()
        meets = trees.join(asked_of, "block").select("block", "group", "tree")
        return meets.groupBy("block", "group").cogroup(pairs.groupBy("p_block", "p_group")).applyInPandas(search, "query_id long, vec_id long, score long")

    def best(found: DataFrame) -> DataFrame:
        return found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))

    home = written(home, "homes")
    first = written(searched(home), "first")
    reached = asked.join(best(first).select(F.col("query_id").alias("id"), F.when(F.size("best") == k, -F.get("best", F.lit(k - 1))["s"]).alias("least")), "id", "left")
    reached = reached.join(home.select("id", "v", F.col("block").alias("home")), ["id", "v"])

    def others(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(columns=["id", "v", "q_group", "block", "least"])
        if len(left) and len(right):
            q = _matrix(right["v"], dim)
            norm = (q**2).sum(axis=1)
            limit = np.sqrt(np.maximum(norm + most - 2.0 * right["least"].astype(float).fillna(-np.inf).to_numpy(), 0.0)) + SLACK * (np.sqrt(norm) + np.sqrt(most) + 1)
            i, j = np.nonzero((bounds(left, q, most, dim) <= limit[:, None]) & (left["block"].to_numpy()[None, :] != right["home"].to_numpy()[:, None]))
            out = right[["id", "v", "q_group", "least"]].iloc[i].assign(block=left["block"].to_numpy()[j])
        return out[["id", "v", "q_group", "block", "least"]]

    more = written(routers.groupBy("q_group", "chunk").cogroup(at_chunks(reached)).applyInPandas(others, f"{sent}, least long"), "others")
    # at most k rows of each tree for a query; the best k of these by an aggregate
    ranked = best(first.unionByName(searched(more)))
    return ranked.select("query_id", F.posexplode("best").alias("pos", "hit")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))


def op5_mtree(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
