"""Streaming duplicates: batch by batch what the batch operator finds in everything so far."""

from __future__ import annotations

import os
import random

import pytest
from road_rows import lines_df
from tsuji.operators import quality
from tsuji.session import scratch_path
from tsuji.streaming import duplicates


def test_batches_equal_the_batch_operator(spark):
    rnd = random.Random(8)
    lines = [[(0, 0), (1, 1)], [(1, 1), (0, 0)], [(2, 2), (3, 3), (4, 4)], [(0.0, 1), (1, 2)], [(-0.0, 1), (1, 2)], None, [(7, 7), (8, 8)]]
    rows = [(str(i), rnd.choice(["a", "b", "b", "c", None]) if i > 20 else "a", lines[6] if i % 3 == 0 else rnd.choice(lines[:6])) for i in range(120)]
    df = lines_df(spark, rows, "fid string, source_mesh string").selectExpr("cast(fid as long) fid", "source_mesh", "line").orderBy("fid")
    root = scratch_path(spark, "sd")
    seen = df.limit(0)
    for k in range(4):
        part = df.where(f"fid >= {30 * k} and fid < {30 * k + 30}")
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
        seen = seen.unionByName(part)
        assert duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", df.schema) >= 1
        got = sorted((r.fid, r.source_mesh or "") for r in spark.read.schema(duplicates.ROW).parquet(f"{root}/out").collect())
        want = sorted((r.fid, r.source_mesh or "") for r in quality.cross_mesh_duplicates(seen).collect())
        assert got == want, k
    assert got
    again = len(os.listdir(f"{root}/out".replace("file:", "")))
    duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", df.schema)            # nothing new, nothing twice
    assert spark.read.schema(duplicates.ROW).parquet(f"{root}/out").count() == len(want) and again


def test_state_is_kept_without_a_python_call_per_geometry(spark):
    """Mostly single geometries, one hot one, rows without a mesh: no row passes through Python on its way."""
    rows = spark.range(6000).selectExpr(
        "id AS fid", "CASE WHEN id % 97 = 1 THEN NULL WHEN id % 3 = 0 AND id < 3000 THEN 'a' ELSE element_at(array('b', 'c'), cast(1 + id % 2 AS int)) END AS source_mesh",
        "array(struct(cast(CASE WHEN id % 3 = 0 THEN -1 ELSE id % 5500 END AS double) AS x, 0D AS y)) AS line")
    root = scratch_path(spark, "sd")
    for k in range(2):
        rows.where(f"fid >= {3000 * k} and fid < {3000 * k + 3000}").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    plan = duplicates.shared_geometries(stream)._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "Python" not in plan and "TransformWithState" not in plan
    assert duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", rows.schema) >= 2
    got = sorted(r.fid for r in spark.read.schema(duplicates.ROW).parquet(f"{root}/out").collect())
    assert got == sorted(r.fid for r in quality.cross_mesh_duplicates(rows).collect()) and 2000 <= len(got) < 6000


def _delivered(spark, root, n=900, batches=3):
    """Geometries of one, two and many rows, within a batch and across batches, some without a mesh."""
    rows = spark.range(n).selectExpr(
        "id AS fid", "CASE WHEN id % 19 = 1 THEN NULL ELSE element_at(array('a', 'b', 'c'), cast(1 + id % 7 % 3 AS int)) END AS source_mesh",
        "CASE WHEN id % 23 = 0 THEN NULL ELSE array(struct(cast(CASE WHEN id % 5 = 0 THEN -1 WHEN id % 5 = 1 THEN id % 350 ELSE id END AS double) AS x, 0D AS y)) END AS line")
    size = n // batches
    for k in range(batches):
        rows.where(f"fid >= {size * k} and fid < {size * k + size}").coalesce(1).write.mode("append").parquet(f"{root}/in")
    return rows


def _flagged(spark, root):
    return sorted(r.fid for r in spark.read.schema(duplicates.ROW).parquet(f"{root}/out").collect())


def _expected(rows):
    return sorted(r.fid for r in quality.cross_mesh_duplicates(rows).collect())


@pytest.mark.parametrize("few", [0, 500_000])
def test_batches_are_held_against_the_log_at_once(spark, monkeypatch, few):
    """No state store, which costs lookups a row: a row is in the log once; keys broadcast or not, the rows are the same."""
    monkeypatch.setattr(duplicates, "FEW", few, raising=False)
    root = scratch_path(spark, "sd")
    rows = _delivered(spark, root)
    assert duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", rows.schema) >= 3
    assert _flagged(spark, root) == _expected(rows)
    assert not os.path.exists(f"{root}/cp/state".replace("file:", ""))
    assert spark.read.parquet(f"{root}/cp/rows").count() == rows.where("line IS NOT NULL").count()


def test_a_batch_that_fails_or_is_run_again_flags_each_row_once(spark, monkeypatch):
    root = scratch_path(spark, "sd")
    rows = _delivered(spark, root)
    shared_now, fails = duplicates._shared_now, []

    def fails_once(log, batch_id):
        if batch_id == 1 and not fails:
            fails.append(batch_id)
            raise ValueError("fails once")
        return shared_now(log, batch_id)

    monkeypatch.setattr(duplicates, "_shared_now", fails_once)
    run = lambda: duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", rows.schema)
    with pytest.raises(Exception, match="fails once"):
        run()
    some = _flagged(spark, root)
    assert some and set(some) < set(_expected(rows))
    run()
    assert _flagged(spark, root) == _expected(rows)
    for name in ("commits/2", "commits/.2.crc"):                       # written, published and not recorded
        os.remove(f"{root}/cp/{name}".replace("file:", ""))
    run()
    assert _flagged(spark, root) == _expected(rows)


def test_a_log_that_lacks_a_batch_is_an_error(spark):
    root = scratch_path(spark, "sd")
    rows = _delivered(spark, root, batches=1)
    duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", rows.schema)
    os.rename(f"{root}/cp/rows".replace("file:", ""), f"{root}/cp/gone".replace("file:", ""))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        duplicates.run(spark, f"{root}/in", f"{root}/out", f"{root}/cp", rows.schema)
