"""Costly steps are dealt out to many tasks, however few files, row groups or meshes their rows come from."""

from __future__ import annotations

import zipfile

from pyspark.sql import functions as F

from tsuji.plans import geometry
from tsuji.session import scratch_path
from tsuji.sources import geojson


def test_archives_of_one_mesh_are_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(geojson, "ROWS_PER_TASK", 20)
    rows = spark.range(400).selectExpr("id AS fid", "CASE WHEN id < 380 THEN '3622' ELSE '3631' END AS mesh", "'1' AS N13_002",
                                       "array(struct(cast(id AS double) AS x, 0D AS y), struct(1D AS x, 1D AS y)) AS geometry")
    root = scratch_path(spark, "many")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")         # as for a large delivery
    try:
        wrote = geojson.write_mesh_archives(rows, root, features_per_archive=10).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    per_task = {}
    for r in wrote:
        per_task[r.task] = per_task.get(r.task, 0) + r.features
    assert sum(per_task.values()) == 400 and len(per_task) > 10 and max(per_task.values()) < 150
    with zipfile.ZipFile(f"{root.removeprefix('file:')}/{wrote[0].archive}") as z:
        assert any(n.endswith(".geojson") for n in z.namelist())
    back = geojson.read_mesh_archives(spark, root)
    assert sorted(int(r.fid) for r in back.select("fid").collect()) == list(range(400))


def test_polygons_of_one_row_group_are_swept_by_many_tasks(spark):
    root = scratch_path(spark, "customers")
    spark.range(2000).selectExpr("id % 1900 AS c_custkey").coalesce(1).write.parquet(f"{root}/customer.parquet")
    rows = geometry.polygon_faults(spark, root).withColumn("task", F.spark_partition_id()).collect()
    tasks = [r.task for r in rows]
    assert len(rows) == 2000 and len({r.fid for r in rows}) == 1900
    assert len(set(tasks)) >= spark.sparkContext.defaultParallelism and max(tasks.count(t) for t in set(tasks)) < 400
