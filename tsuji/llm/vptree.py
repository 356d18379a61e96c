"""Approximate nearest neighbours: a vantage-point tree per shard.

Nearness is the largest inner product. With one more component, ``sqrt(M^2 - |x|^2)`` on the data
side (``M`` the largest norm) and 0 on the query side, squared distance is ``|q|^2 + M^2 - 2 q.x``:
the same order in a metric space, so the triangle inequality may prune. A child whose distance shell
lies further from the query than ``factor`` times the query's current k-th distance is skipped;
``factor = 1`` skips only what cannot matter and makes the search exact.

Shards are regions: an upper vantage-point tree, fitted on a bounded sample (``SAMPLE_ROWS`` per vector
length), deals every row to one region, and of each region the true range of distances to the vantage
points on its path is known. A region of many rows (a cluster, one vector repeated) is several shards. Every
row is in exactly one shard's tree; trees are built inside the tasks that search them.

A query is searched in its own region first. The distance of its k-th best there is its radius; it is then
sent to those other regions alone whose shells come within ``factor`` times that radius. So on clustered
vectors a query meets a few regions however many there are. A block of queries searches a tree as one batch
(matrix products in the leaves), and the shards' bests are merged per query.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part; rows
without an id take no part; rows that share the query's id count as its own; equal
rows of one id are one query; vectors meet only vectors of their length; ties go to the smaller id; fewer candidates than ``k`` give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepared, written
from .vectors import best_of, matrix, packed

K = 20
EVERY = 20                     # queries: ids divisible by this
FACTOR = 0.5                   # recall 1.000 on uniform 64-component vectors, 0.998 with many equal ones (0.15: 0.97)
SHARD_ROWS = 4096
SAMPLE_ROWS = 16_384           # rows of every vector length the upper tree is fitted on
REGION_SAMPLE = 16             # sample rows a region needs at least
BLOCK_ROWS = 8192              # queries searched together
LEAF = 256


class Tree:
    """Vantage-point tree over the rows of ``points``; nodes split at the median distance."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 7):
        self.points, self.leaf = points, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # of a few candidates, the vantage point whose distances spread most
        spread = []
        for c in self.rng.choice(rows, 4):
            d = np.linalg.norm(self.points[rows] - self.points[c], axis=1)
            spread.append((d.std(), int(c), d))
        _, vantage, d = max(spread, key=lambda x: (x[0], x[1]))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        return (vantage, (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]]),
                self._build(np.sort(rows[near])), self._build(np.sort(rows[far])))


class Search:
    """A batch of queries against one tree. ``best`` holds sortable keys: squared distance on a fine
    grid, then row number, so that equal distances keep the smaller row (rows are in id order)."""

    def __init__(self, tree: Tree, queries: np.ndarray, own: np.ndarray, k: int, factor: float):
        self.t, self.q, self.own, self.k, self.factor = tree, queries, own, k, factor
        self.sq_p = (tree.points ** 2).sum(1)
        self.sq_q = (queries ** 2).sum(1)
        self.bits = max(1, int(len(tree.points)).bit_length())
        self.grid = float(1 << (61 - self.bits)) / max(4.0 * max(self.sq_p.max(), self.sq_q.max()), 1e-300)
        self.best = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.visits = 0
        self._visit(tree.root, np.arange(len(queries)))

    def radius(self, act: np.ndarray) -> np.ndarray:
        """Distance of the current k-th best."""
        last = self.best[act, -1]
        d2 = ((last >> self.bits) + 1) / self.grid
        return np.where(last == np.iinfo(np.int64).max, np.inf, np.sqrt(d2))

    def _visit(self, node, act: np.ndarray) -> None:
        if len(act) == 0:
            return
        if isinstance(node, np.ndarray):
            self.visits += len(act) * len(node)
            d2 = self.sq_q[act, None] + self.sq_p[node] - 2 * (self.q[act] @ self.t.points[node].T)
            keys = ((np.maximum(d2, 0) * self.grid).astype(np.int64) << self.bits) | node
            keys[self.own[act, None] == node] = np.iinfo(np.int64).max
            both = np.concatenate([self.best[act], keys], 1)
            both.partition(self.k - 1, axis=1)
            self.best[act] = both[:, :self.k]
            self.best[act, -1] = both[:, self.k - 1]
            return
        vantage, inner, outer, near, far = node
        d = np.sqrt(np.maximum(self.sq_q[act] + self.sq_p[vantage] - 2 * (self.q[act] @ self.t.points[vantage]), 0))
        gap = lambda s: np.maximum(0, np.maximum(d - s[1], s[0] - d)) * (1 - 1e-9) - 1e-9
        to_near, to_far = gap(inner), gap(outer)
        inside = d <= (inner[1] + outer[0]) / 2
        self._visit(near, act[inside])
        self._visit(far, act[~inside])
        for child, mine, lower in ((far, inside, to_far), (near, ~inside, to_near)):
            rest = act[mine]
            self._visit(child, rest[lower[mine] <= self.factor * self.radius(rest)])


def search_shard(ids, vecs, norm2, q_ids, q_vecs, dim: int, top2: float, k: int, factor: float) -> pd.DataFrame:
    """The ``k`` nearest rows of one shard for every query of a block, scored on the given vectors."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], matrix(vecs, dim)[order]
    aug = np.sqrt(np.maximum(top2 - norm2[order], 0))
    q = matrix(q_vecs, dim)
    places = {}
    for i, v in enumerate(ids.tolist()):
        places.setdefault(v, []).append(i)
    shared = any(len(p) > 1 for p in places.values())
    own = np.array([places.get(v, [-1])[0] for v in q_ids.tolist()])
    extra = max((len(p) for p in places.values()), default=1) - 1 if shared else 0   # rows repeating an id
    tree = Tree(np.column_stack([x, aug]))
    take = min(k + extra, max(1, len(ids)))
    s = Search(tree, np.column_stack([q, np.zeros(len(q))]), own, take, factor)
    qi, col = np.nonzero(s.best != np.iinfo(np.int64).max)
    row = s.best[qi, col] & ((1 << s.bits) - 1)
    keep = ids[row] != q_ids[qi]
    qi, row = qi[keep], row[keep]
    score = np.einsum("ij,ij->i", q[qi], x[row])
    return pd.DataFrame({"query_id": q_ids[qi], "vec_id": ids[row], "score": score})


class Upper:
    """Vantage-point tree over a sample; its leaves are the regions. ``path[r]`` are the vantage points above
    region r, and ``low`` and ``high`` the distances of the region's rows to them (``fitted``)."""

    def __init__(self, points: np.ndarray, regions: int, seed: int = 11):
        self.points, self.rng = points, np.random.default_rng(seed)
        self.vantage: list[int] = []
        self.path: list[list[int]] = []
        self.root = self._build(np.arange(len(points)), max(1, regions), [])
        self.places = points[self.vantage] if self.vantage else np.zeros((0, points.shape[1]))
        del self.points, self.rng

    def _build(self, rows: np.ndarray, regions: int, path: list[int]):
        d = np.zeros(len(rows))
        if regions > 1 and len(rows) >= 2 * REGION_SAMPLE:
            spread = []
            for c in self.rng.choice(rows, 4):
                d = np.linalg.norm(self.points[rows] - self.points[c], axis=1)
                spread.append((d.std(), int(c), d))
            _, c, d = max(spread, key=lambda x: (x[0], x[1]))
        split = float(np.median(d)) if len(d) else 0.0
        near = d <= split
        if near.all():                                           # one region, or rows all alike
            self.path.append(path)
            return len(self.path) - 1
        v = len(self.vantage)
        self.vantage.append(c)
        left = self._build(rows[near], regions // 2, [*path, v])
        return v, split, left, self._build(rows[~near], regions - regions // 2, [*path, v])

    def distances(self, points: np.ndarray) -> np.ndarray:
        d2 = (points ** 2).sum(1)[:, None] + (self.places ** 2).sum(1) - 2 * points @ self.places.T
        return np.sqrt(np.maximum(d2, 0))

    def region(self, d: np.ndarray) -> np.ndarray:
        """Region of every row of a matrix of distances to the vantage points."""
        out = np.zeros(len(d), np.int32)

        def descend(node, rows):
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                v, split, near, far = node
                closer = d[rows, v] <= split
                descend(near, rows[closer])
                descend(far, rows[~closer])

        descend(self.root, np.arange(len(d)))
        return out

    def gaps(self, d: np.ndarray, low: dict, high: dict) -> np.ndarray:
        """Least distance that a row of each region can have from each query, by the triangle inequality;
        infinite for regions without rows."""
        out = np.zeros((len(d), len(self.path)))
        for r, path in enumerate(self.path):
            if path and (r, path[0]) not in low:
                out[:, r] = np.inf
            for v in path:
                if (r, v) in low:
                    np.maximum(out[:, r], np.maximum(d[:, v] - high[r, v], low[r, v] - d[:, v]), out=out[:, r])
        return out * (1 - 1e-9) - 1e-9


def _upper_trees(rows: DataFrame, sizes: dict, shard_rows: int) -> dict[int, Upper]:
    """One upper tree per vector length."""
    want = {d: max(1, -(-n // shard_rows)) for d, (n, _) in sizes.items()}
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec", "id")))
    most = min(SAMPLE_ROWS, 4 * REGION_SAMPLE * max(want.values()))
    sample = rows.withColumn("r", rank).where(F.col("r") <= most).orderBy("dim", "r").select("dim", "vec", "norm2").collect()
    out = {}
    for d, (_, top2) in sizes.items():
        mine = [r for r in sample if r["dim"] == d]
        x = matrix([bytes(r.vec) for r in mine], d)
        aug = np.sqrt(np.maximum(top2 - np.array([r.norm2 for r in mine]), 0))
        out[d] = Upper(np.column_stack([x, aug]), want[d])
    return out


def _augmented(batch: pa.RecordBatch, at: np.ndarray, dim: int, top2: float, is_query: bool) -> np.ndarray:
    x = matrix([batch.column("vec")[int(i)].as_py() for i in at], dim)
    aug = np.zeros(len(at)) if is_query else np.sqrt(np.maximum(top2 - batch.column("norm2").to_numpy()[at], 0))
    return np.column_stack([x, aug])


def _located(rows: DataFrame, upper: dict[int, Upper], sizes: dict, is_query: bool) -> DataFrame:
    """Rows with their region."""
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            region = np.zeros(len(dims), np.int32)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                u = upper[int(d)]
                region[at] = u.region(u.distances(_augmented(batch, at, int(d), sizes[int(d)][1], is_query)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "dim", "vec", "norm2")), pa.array(region)],
                                             names=["id", "dim", "vec", "norm2", "region"])

    return prepared(rows.select("id", "dim", "vec", "norm2")).mapInArrow(run, "id long, dim int, vec binary, norm2 double, region int")


def _shells(data: DataFrame, upper: dict[int, Upper], sizes: dict) -> dict[int, tuple[dict, dict]]:
    """Per vector length: least and greatest distance of each region's rows to each vantage point on its path."""
    def run(batches):
        for batch in batches:
            dims, region = batch.column("dim").to_numpy(), batch.column("region").to_numpy()
            rows = []
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                u = upper[int(d)]
                far = u.distances(_augmented(batch, at, int(d), sizes[int(d)][1], False))
                for r in np.unique(region[at]):
                    mine = far[region[at] == r]
                    rows += [(int(d), int(r), v, float(mine[:, v].min()), float(mine[:, v].max())) for v in u.path[r]]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             names=["dim", "region", "v", "low", "high"])

    seen = (data.mapInArrow(run, "dim int, region int, v int, low double, high double").groupBy("dim", "region", "v")
            .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())      # regions times their depth
    out: dict[int, tuple[dict, dict]] = {d: ({}, {}) for d in sizes}
    for r in seen:
        out[r.dim][0][r.region, r.v], out[r.dim][1][r.region, r.v] = r.low, r.high
    return out


def _routed(queries: DataFrame, upper: dict[int, Upper], shells: dict, sizes: dict, factor: float) -> DataFrame:
    """Queries (with the score of their k-th best so far) once for every other region they may gain from."""
    names = ["id", "dim", "vec", "region"]

    def run(batches):
        for batch in batches:
            dims, home = batch.column("dim").to_numpy(), batch.column("region").to_numpy()
            kth = batch.column("kth").to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                u, top2 = upper[int(d)], sizes[int(d)][1]
                radius = np.sqrt(np.maximum(batch.column("norm2").to_numpy()[at] + top2 - 2 * kth[at], 0))
                radius = np.where(np.isnan(kth[at]), np.inf, radius)                 # fewer than k found: all regions
                gap = u.gaps(u.distances(_augmented(batch, at, int(d), top2, True)), *shells[int(d)])
                send = (gap <= factor * radius[:, None]) & (gap < np.inf)
                send[np.arange(len(at)), home[at]] = False
                q, r = np.nonzero(send)
                part = batch.take(pa.array(at[q]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:3]), pa.array(r.astype(np.int32))], names=names)

    return prepared(queries).mapInArrow(run, "id long, dim int, vec binary, region int")


def _searched(data: DataFrame, counts: DataFrame, queries: DataFrame, k: int, factor: float, sizes: dict, shard_rows: int, block_rows: int) -> DataFrame:
    """Bests of every query in the regions it was sent to. Rows of regions that no query wants stay where they are."""
    asked = queries.groupBy("dim", "region").agg(F.count(F.lit(1)).alias("asked"))
    plan = counts.join(asked, ["dim", "region"]).select(
        "dim", "region", F.expr(f"cast((n + {shard_rows - 1}) div {shard_rows} as int)").alias("shards"),
        F.expr(f"cast((asked + {block_rows - 1}) div {block_rows} as int)").alias("blocks"))
    plan = F.broadcast(plan)                                     # a row per region: bounded by the sample
    piece = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n)).cast("int")
    left = (data.join(plan, ["dim", "region"]).withColumn("shard", piece("shards", 1))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    right = (queries.join(plan, ["dim", "region"]).withColumn("block", piece("blocks", 2))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))))

    def solve(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return search_shard(a["id"].to_numpy(), a["vec"], a["norm2"].to_numpy(), b["id"].to_numpy(), b["vec"], int(key[0]),
                            sizes[int(key[0])][1], k, factor)

    keys = ["dim", "region", "shard", "block"]
    return (left.select(*keys, "id", "vec", "norm2").groupBy(*keys).cogroup(right.select(*keys, "id", "vec").groupBy(*keys))
            .applyInPandas(solve, "query_id long, vec_id long, score double"))


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY,
            factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    rows = written(packed(df, id_col, vec_col, drop_zero=True), "vp-rows")
    sizes = {r.dim: (r.n, float(r.top2)) for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top2")).collect()}
    if not sizes:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    upper = _upper_trees(rows, sizes, shard_rows)
    data = written(_located(rows, upper, sizes, False), "vp-data")
    # repeats of a query row are one query: each would find the same rows again
    asked = rows.where(F.col("id") % every == 0).select("id", "dim", "vec", "norm2").distinct()
    queries = written(_located(asked, upper, sizes, True), "vp-queries")
    counts = data.groupBy("dim", "region").agg(F.count(F.lit(1)).alias("n"))
    search = lambda q: _searched(data, counts, q, k, factor, sizes, shard_rows, block_rows)

    first = written(best_of(search(queries.select("id", "dim", "vec", "region")), k).drop("rank"), "vp-home")
    kth = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    routed = written(_routed(queries.join(kth, "id", "left"), upper, _shells(data, upper, sizes), sizes, factor), "vp-routed")
    found = best_of(first.unionByName(search(routed)), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
