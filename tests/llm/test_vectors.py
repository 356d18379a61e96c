"""Both vector searches against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tsuji.llm import voronoi, vptree
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def brute(rows, k, every, scale=None):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    if scale is None:
        ok = [(i, v) for i, v in ok if any(v)]
    f = (lambda x: math.floor(scale * x)) if scale else (lambda x: x)
    ok = [(i, [f(x) for x in v]) for i, v in ok]
    out = {}
    for i, v in ok:
        if i % every == 0:
            c = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v)]
            out[i] = [(j, -s) for s, j in sorted(c)[:k]]
    return out


def as_dict(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_exact_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert as_dict(QUERIES["op10_voronoi"](spark, SF).collect()) == brute(rows, 10, 100, 1024)


def test_recall_and_exact_scores(spark):
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = as_dict(QUERIES["op8_vptree"](spark, SF).collect())
    ids = np.array(sorted(rows))
    x = np.stack([rows[i] for i in ids])
    hit = total = 0
    assert set(got) == {i for i in rows if i % 20 == 0}
    for q, found in got.items():
        s = x @ rows[q]
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        assert len(found) == 20 and all(abs(rows[q] @ rows[j] - v) < 1e-12 for j, v in found)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
        hit += len(best & {j for j, _ in found})
        total += 20
    assert hit >= 0.9 * total, hit / total


@pytest.mark.parametrize("clustered", [True, False])
def test_factor_one_and_small_groups_are_exact(spark, clustered):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 5
    x = [(centres[i % 8] if clustered else 0) + rng.normal(size=6) for i in range(700)]
    x[5] = x[105] = x[200] = x[201]                       # ties
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = brute(rows, 7, 10)
    got = as_dict(vptree.nearest(df, k=7, every=10, factor=1.0, shard_rows=300, block_rows=30).collect())
    assert {q: [j for j, _ in v] for q, v in got.items()} == {q: [j for j, _ in v] for q, v in want.items()}
    got = as_dict(voronoi.top_k(df, k=7, every=10, n_pivots=12, group_rows=9, share_rows=200).collect())
    assert got == brute(rows, 7, 10, 1024)


def test_replication_is_pruned_on_clusters():
    """In clustered data most rows are ruled out for a group."""
    rng = np.random.default_rng(1)
    gap = voronoi.distances(p := rng.normal(size=(10, 4)) * 100, z := np.zeros(10), p, z)
    radius = np.full(10, 1.0)
    theta = voronoi.bounds(gap, radius, [[0.1] * 5] * 10, 3)
    low, _ = voronoi.shells(gap, radius, theta, np.arange(10), 10)
    assert (low > 2).sum() >= 60


def test_unusable_rows_few_rows_and_extra_columns(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], "a"), (100, [0.5, 0.5], "b"), (100, [0.5, 0.25], "b"), (3, None, "c"), (4, [nan, 1.0], "d"), (5, [None, 1.0], "e"),
            (6, [float("inf"), 1.0], "f"), (7, [0.0, 0.0], "g"), (None, [1.0, 1.0], "h"), (8, [1.0, 2.0, 3.0], "i"), (200, [], "j")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    a = as_dict(vptree.nearest(df).collect())
    assert {q: [j for j, _ in v] for q, v in a.items()} == {0: [100, 100], 100: [0]} or {q: [j for j, _ in v] for q, v in a.items()} == {0: [100, 100], 100: [0, 0]}
    b = as_dict(voronoi.top_k(df).collect())
    assert [j for j, _ in b[0]] == [100, 100, 7]
    assert vptree.nearest(df.limit(0)).collect() == [] and voronoi.top_k(df.limit(0)).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0 ** 20, 1.0]), (1, [2.0 ** 20, 3.0]), (2, [2.0 ** 20, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert as_dict(voronoi.top_k(df, every=5).collect()) == brute(rows, 10, 5, 1024)


def test_repeated_ids_keep_the_exact_search_exact(spark):
    """An id in more rows than k: its own rows must not stand for candidates in the bound."""
    rng = np.random.default_rng(5)
    own = [(100, [9.0, 9.0])] * 11
    others = [(i, [float(v) for v in 5 + rng.normal(size=2)]) for i in range(1, 51)]
    df = spark.createDataFrame(own + others, "vec_id long, embedding array<double>").repartition(3)
    want = brute(own + others, 10, 100, 1024)[100]
    # the 11 equal rows are one query, which has its 10 best candidates
    assert as_dict(voronoi.top_k(df).collect()) == {100: want}
    several = [(100, [9.0, 9.0 - j / 64]) for j in range(11)]
    df = spark.createDataFrame(several + others, "vec_id long, embedding array<double>").repartition(3)
    pairs = [(-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(q, v)), j) for _, q in several for j, v in others]
    assert as_dict(voronoi.top_k(df).collect()) == {100: [(j, -s) for s, j in sorted(pairs)[:10]]}


def test_repeated_query_rows_are_one_query_of_the_trees(spark):
    rng = np.random.default_rng(6)
    rows = [(20, [1.0, 2.0, 0.5])] * 7 + [(i, [float(v) for v in rng.normal(size=3)]) for i in range(21, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = {20: [j for j, _ in brute(rows, 8, 20)[20]]}
    assert {q: [j for j, _ in v] for q, v in as_dict(vptree.nearest(df, k=8, factor=1.0).collect()).items()} == want


def test_equal_query_rows_do_not_crowd_candidates_out(spark):
    rng = np.random.default_rng(8)
    rows = [(100, [1.0, 2.0, 0.5])] * 5 + [(i, [float(v) for v in rng.normal(size=3)]) for i in range(101, 180)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = as_dict(voronoi.top_k(df, n_pivots=6, share_rows=9).collect())
    assert got == {100: brute(rows, 10, 100, 1024)[100]} and len({j for j, _ in got[100]}) == 10


def copies_sent(spark, n, factor=0.5):
    """Query rows sent beyond their own region, and regions, for n clustered vectors of length one."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(n // 200, 8))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, 8)) * 0.02
    x = np.float32(x / np.linalg.norm(x, axis=1, keepdims=True))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    rows = vptree.written(vptree.packed(df, "vec_id", "embedding", drop_zero=True), "t")
    n, top2 = rows.agg(vptree.F.count("*"), vptree.F.max("norm2")).first()
    sizes = {8: (n, top2)}
    upper = vptree._upper_trees(rows, sizes, 400)
    data = vptree.written(vptree._located(rows, upper, sizes, False), "t")
    asked = vptree._located(rows.where("id % 20 = 0"), upper, sizes, True)
    home = vptree.best_of(vptree._searched(data, data.groupBy("dim", "region").agg(vptree.F.count("*").alias("n")),
                                           asked.select("id", "dim", "vec", "region"), 20, factor, sizes, 400, 8192), 20)
    kth = home.groupBy(vptree.F.col("query_id").alias("id")).agg(vptree.F.min("score").alias("kth"))
    routed = vptree._routed(asked.join(kth, "id", "left"), upper, vptree._shells(data, upper, sizes), sizes, factor)
    return routed.count(), len(upper[8].path)


def test_copies_of_queries_grow_in_proportion_on_clustered_vectors(spark):
    few, regions = copies_sent(spark, 4000)
    many, more = copies_sent(spark, 16_000)
    assert more >= 3 * regions
    assert many <= 8 * max(few, 4000 // 20) and many < 0.2 * (16_000 // 20) * more     # not four times four as many


def test_regions_of_equal_vectors_and_several_lengths_are_exact(spark):
    rng = np.random.default_rng(10)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(900)] + [(1000 + i, [float(v) for v in rng.normal(size=3)]) for i in range(300)]
    rows += [(5000 + i, [float(v) for v in rng.normal(size=5) * 3]) for i in range(260)] + [(9000, [4.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = as_dict(vptree.nearest(df, k=6, every=100, factor=1.0, shard_rows=50, block_rows=4).collect())
    want = {q: [j for j, _ in v] for q, v in brute(rows, 6, 100).items() if v}
    assert {q: [j for j, _ in v] for q, v in got.items()} == want
