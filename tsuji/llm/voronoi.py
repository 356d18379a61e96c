"""Exact top-k search: a Voronoi kNN join.

Components become integers, the score is the integer inner product. One more component,
``sqrt(M^2 - |x|^2)`` for data and 0 for queries, turns the largest inner product into the smallest
Euclidean distance, so distances to pivots bound scores.

1. Pivots (a bounded, repeatable choice of rows) split data and queries into cells; every row knows
   its distance to its pivot.
2. Summaries, a few numbers per cell: per data cell the ``k + 1`` smallest distances to the pivot, one
   row counting for every id; per query cell the largest. From them follows, for every query cell, a distance
   within which each of its queries surely has ``k`` candidates.
3. Query cells are joined into groups. A data row goes to a group only if the triangle inequality
   cannot rule it out for all of the group's cells.
4. Each (group, block of queries, share of data) is solved on its own by matrix products, and the
   shares' bests are merged.

Results are exact whatever the pivots; where the data has no cluster structure the bounds rule
little out and step 3 sends every row to every group, of which there are few.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor
rows without an id; a zero vector does; rows that share the query's id count as its own; equal rows of one
id are one query, while different vectors of one id share its ``k`` ranks; a candidate counts once per row;
vectors meet only vectors of their length; ties go to the smaller id; fewer candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepared, written
from .vectors import best_of, matrix, packed

K = 10
EVERY = 100                    # queries: ids divisible by this
SCALE = 1024.0
PIVOTS = 64                    # per vector length; the summaries have PIVOTS * (k + 1) numbers
GROUP_ROWS = 1024              # queries a group aims at, and the most in a block
SHARE_ROWS = 8192              # data rows of a group solved in one task

EXACT = float(1 << 53)


def distances(x: np.ndarray, aug2: np.ndarray, p: np.ndarray, p_aug2: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots in the space with the additional component."""
    d2 = ((x ** 2).sum(1)[:, None] + (p ** 2).sum(1) - 2 * x @ p.T
          + (np.sqrt(aug2)[:, None] - np.sqrt(p_aug2)) ** 2)
    return np.sqrt(np.maximum(d2, 0))


def assigned(rows: DataFrame, pivots: dict, top2: float, is_query: bool) -> DataFrame:
    """Rows with their cell and distance to its pivot."""
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell, dist = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = matrix([batch.column("vec")[int(i)].as_py() for i in at], int(d))
                a2 = np.zeros(len(at)) if is_query else np.maximum(top2 - (x ** 2).sum(1), 0)
                p, p2 = pivots[int(d)]
                far = distances(x, a2, p, p2)
                cell[at] = far.argmin(1)
                dist[at] = far[np.arange(len(at)), cell[at]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("dim"), batch.column("vec"), pa.array(cell), pa.array(dist)],
                names=["id", "dim", "vec", "cell", "dist"])

    return prepared(rows).select("id", "dim", "vec").mapInArrow(run, "id long, dim int, vec binary, cell int, dist double")


def bounds(pivot_gap: np.ndarray, q_radius: np.ndarray, near: list[list[float]], k: int) -> np.ndarray:
    """Per query cell: a distance within which every query of the cell has data rows of ``k + 1`` ids
    (one of them may be its own). ``near[j]`` are the smallest distances of data cell ``j``, at most
    one of every id."""
    out = np.full(len(q_radius), np.inf)
    for i, r in enumerate(q_radius):
        if np.isnan(r):
            continue
        reach = np.sort(np.concatenate([r + pivot_gap[i, j] + np.array(n) for j, n in enumerate(near)] or [np.zeros(0)]))
        if len(reach) > k:
            out[i] = reach[k]
    return out


def shells(pivot_gap: np.ndarray, q_radius: np.ndarray, theta: np.ndarray, group_of: np.ndarray, groups: int):
    """(low, high) per (group, data cell): rows whose distance to their pivot lies outside cannot be
    among the ``k`` best of any query of the group."""
    cells = pivot_gap.shape[1]
    low, high = np.full((groups, cells), np.inf), np.full((groups, cells), -np.inf)
    for i, g in enumerate(group_of):
        if g >= 0:
            slack = 1e-9 * (1 + pivot_gap[i] + q_radius[i])
            low[g] = np.minimum(low[g], pivot_gap[i] - q_radius[i] - theta[i] - slack)
            high[g] = np.maximum(high[g], pivot_gap[i] + q_radius[i] + theta[i] + slack)
    return low, high


def grouped(counts: np.ndarray, pivot_gap: np.ndarray, group_rows: int) -> np.ndarray:
    """Group of every query cell (-1 for empty ones): a cell joins the group it starts nearest to
    until the group is full, so groups are compact."""
    group = np.full(len(counts), -1)
    open_ = set(np.flatnonzero(counts > 0).tolist())
    g = 0
    while open_:
        seed = max(open_, key=lambda c: (counts[c], -c))
        size = 0
        for c in sorted(open_, key=lambda c: (pivot_gap[seed, c], c)):
            if size and size + counts[c] > group_rows:
                break
            group[c] = g
            size += counts[c]
            open_.discard(c)
        g += 1
    return group


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while every partial sum fits 53 bits, else in
    Python's integers."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if top < EXACT:
        return q @ x.T
    whole = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object).reshape(m.shape)
    return whole(q) @ whole(x).T


def solve_share(ids, x: np.ndarray, q_ids, q: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best rows of a share for every query, smaller ids first among equals."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    out_q, out_v, out_s = [], [], []
    step = max(1, 4_000_000 // max(1, len(ids)))
    for a in range(0, len(q), step):
        score = inner(q[a:a + step], x)
        for i in range(len(score)):
            s = score[i]
            other = ids != q_ids[a + i]
            if not other.all():
                s, mine = s[other], ids[other]
            else:
                mine = ids
            if len(s) > k and s.dtype != object:
                least = np.partition(s, len(s) - k)[len(s) - k]
                above = np.flatnonzero(s > least)
                best = np.concatenate([above, np.flatnonzero(s == least)[:k - len(above)]])
            else:
                best = np.arange(len(s))
            best = best[np.argsort(-s[best], kind="stable")][:k]
            out_q += [q_ids[a + i]] * len(best)
            out_v.append(mine[best])
            out_s += [int(v) for v in s[best]]
    return pd.DataFrame({"query_id": np.array(out_q, np.int64), "score": np.array(out_s, np.int64),
                         "vec_id": np.concatenate(out_v) if out_v else np.zeros(0, np.int64)})[["query_id", "vec_id", "score"]]


def plan(rows: DataFrame, queries: DataFrame, k: int, group_rows: int, n_pivots: int):
    """Cells' geometry per vector length: low and high shells, group of every query cell, query count
    per group. Only summaries (a few numbers per pivot) come to the driver."""
    data_near = (rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))).collect()
    # k + 1 smallest distances per cell: partial top lists per slice of the cell, then their best; an
    # id counts with one of its rows, so that no more than one of them can be a query's own
    from pyspark.sql import Window

    w = Window.partitionBy("dim", "cell", "slice").orderBy("dist")
    w2 = Window.partitionBy("dim", "cell").orderBy("dist")
    slices = max(1, -(-sum(r.n for r in data_near) // (n_pivots * 4096)))
    one = rows.groupBy("dim", "id").agg(F.min(F.struct("dist", "cell")).alias("b"))
    near = (one.select("dim", "b.cell", "b.dist", F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice"))
            .withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
            .withColumn("r", F.row_number().over(w2)).where(F.col("r") <= k + 1)
            .groupBy("dim", "cell").agg(F.sort_array(F.collect_list("dist")).alias("near")).collect())
    asked = queries.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("far")).collect()
    return near, asked


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY,
          scale: float = SCALE, n_pivots: int = PIVOTS, group_rows: int = GROUP_ROWS, share_rows: int = SHARE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    rows = written(packed(df, id_col, vec_col, scale=scale), "voronoi-rows")
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    per_dim = {r.dim: r for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top2")).collect()}
    if not per_dim:
        return empty
    top2 = max(r.top2 for r in per_dim.values())
    from pyspark.sql import Window

    # n_pivots rows of every length, by hash of the vector so that repeats of one vector count once
    picks = (rows.groupBy("dim", F.xxhash64("vec").alias("h")).agg(F.min("vec").alias("vec"))
             .withColumn("r", F.row_number().over(Window.partitionBy("dim").orderBy("h"))).where(F.col("r") <= n_pivots)
             .orderBy("dim", "r").collect())
    pivots = {}
    for d in per_dim:
        p = matrix([bytes(r.vec) for r in picks if r.dim == d], d)
        pivots[d] = (p, np.maximum(top2 - (p ** 2).sum(1), 0))

    data = written(assigned(rows, pivots, top2, False), "voronoi-data")
    # equal rows of an id are one query: each would fill the ranks with the same candidates again
    queries = assigned(rows.where(F.col("id") % every == 0).select("id", "dim", "vec").distinct(), pivots, top2, True)
    queries = written(queries, "voronoi-queries")
    near, asked = plan(data, queries, k, group_rows, n_pivots)

    shell, group_of, blocks = {}, {}, {}
    for d, (p, p2) in pivots.items():
        gap = distances(p, p2, p, p2)          # between pivots
        lists = [[] for _ in range(len(p))]
        for r in near:
            if r.dim == d:
                lists[r.cell] = r.near
        count, far = np.zeros(len(p), int), np.full(len(p), np.nan)
        for r in asked:
            if r.dim == d:
                count[r.cell], far[r.cell] = r.n, r.far
        group = grouped(count, gap, group_rows)
        n_groups = int(group.max()) + 1
        if n_groups == 0:
            continue
        theta = bounds(gap, far, lists, k)
        shell[d] = shells(gap, far, theta, group, n_groups)
        group_of[d] = group
        blocks[d] = [max(1, -(-int(count[group == g].sum()) // group_rows)) for g in range(n_groups)]
    if not group_of:
        return empty

    def wanted(d: int, g: int, dims, cell, dist) -> np.ndarray:
        """Rows that group g cannot rule out."""
        low, high = shell[d]
        mine = cell % low.shape[1]
        return np.flatnonzero((dims == d) & (dist >= low[g][mine]) & (dist <= high[g][mine]))

    def counted(batches):
        """How many rows of a batch each group gets."""
        for batch in batches:
            dims, cell, dist = (batch.column(c).to_numpy() for c in ("dim", "cell", "dist"))
            rows = [(int(d), g, len(wanted(int(d), g, dims, cell, dist)))
                    for d in np.unique(dims) if int(d) in shell for g in range(len(shell[int(d)][0]))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.int64()))],
                                             names=["dim", "grp", "n"])

    # a group's rows are dealt over as many shares as it needs, so its queries are copied no more often
    sent = data.select("dim", "cell", "dist").mapInArrow(counted, "dim int, grp int, n long").groupBy("dim", "grp").agg(F.sum("n").alias("n"))
    shares = {(r.dim, r.grp): max(1, -(-r.n // share_rows)) for r in sent.collect()}

    def send(batches):
        """A data row once for every (group, block) it may matter to."""
        for batch in batches:
            dims, cell, dist = (batch.column(c).to_numpy() for c in ("dim", "cell", "dist"))
            for d in np.unique(dims):
                if int(d) not in shell:
                    continue
                for g in range(len(shell[int(d)][0])):
                    at = wanted(int(d), g, dims, cell, dist)
                    if len(at):
                        part = batch.take(pa.array(at))
                        of = np.full(len(at), shares[int(d), g], np.int32)
                        for b in range(blocks[int(d)][g]):
                            yield pa.RecordBatch.from_arrays(
                                [part.column("id"), part.column("dim"), part.column("vec"),
                                 pa.array(np.full(len(at), g, np.int32)), pa.array(np.full(len(at), b, np.int32)), pa.array(of)],
                                names=["id", "dim", "vec", "grp", "block", "shares"])

    def place(batches):
        """A query's group and block."""
        for batch in batches:
            dims, cell, ids = (batch.column(c).to_numpy() for c in ("dim", "cell", "id"))
            g = np.array([group_of[int(d)][c] for d, c in zip(dims, cell)], np.int32)
            b = np.array([i // every % blocks[int(d)][x] for i, d, x in zip(ids, dims, g)], np.int32)
            of = np.array([shares.get((int(d), int(x)), 1) for d, x in zip(dims, g)], np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("dim"), batch.column("vec"), pa.array(g), pa.array(b), pa.array(of)],
                names=["id", "dim", "vec", "grp", "block", "shares"])

    shape = "id long, dim int, vec binary, grp int, block int, shares int"
    left = data.mapInArrow(send, shape).withColumn("share", F.pmod(F.xxhash64("id"), "shares").cast("int")).drop("shares")
    right = queries.mapInArrow(place, shape).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def solve(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        d = int(key[0])
        return solve_share(a["id"].to_numpy(), matrix(a["vec"], d), b["id"].to_numpy(), matrix(b["vec"], d), k)

    keys = ["dim", "grp", "block", "share"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    return best_of(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
