"""Sources that leave files unopened: the packed R-tree of a layout, and pushed filters of mesh archives."""

from __future__ import annotations

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji.functions import geom
from tsuji.plans.ingest import write_archives
from tsuji.session import scratch_path
from tsuji.sinks import layout, rtree
from tsuji.sources import geojson, mesh_archive

SF = "/root/testdata/sf0.001"


def roads(spark, n=1500):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        x, y = rnd.uniform(0, 100), rnd.uniform(0, 50)
        rows.append((str(i), None if i % 211 == 5 else [] if i % 211 == 6 else [(x, y), (x + rnd.uniform(0, 2), y + rnd.uniform(0, 2))]))
    return lines_df(spark, rows, "fid string").withColumn("fid", F.col("fid").cast("long"))


@pytest.fixture(scope="module")
def indexed(spark):
    df = roads(spark).where("line is not null and size(line) > 0")
    path = layout.write_covering_layout(df, scratch_path(spark, "rt"), num_files=3, file_rows=40)
    rtree.build_index(spark, path, fanout=4)
    return path


def boxes(spark, path):
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("bbox.xmin"), F.min("bbox.ymin"), F.max("bbox.xmax"), F.max("bbox.ymax"))
    return {r[0]: tuple(r)[1:] for r in rows.collect()}


def test_tree_is_packed_and_covers(spark, indexed):
    nodes = spark.read.parquet(f"{indexed}/{rtree.INDEX}").collect()
    files = boxes(spark, indexed)
    levels = {}
    for n in nodes:
        levels.setdefault(n.level, {})[n.node] = n
    assert {n.file: (n.xmin, n.ymin, n.xmax, n.ymax) for n in levels[0].values()} == files
    top = max(levels)
    assert top >= 2 and len(levels[top]) == 1 and sum(n.rows for n in levels[top].values()) == spark.read.parquet(indexed).count()
    for k in range(top):
        assert len(levels[k + 1]) == -(-len(levels[k]) // 4)
        for n in levels[k].values():
            p = levels[k + 1][n.parent]
            assert p.xmin <= n.xmin and p.ymin <= n.ymin and p.xmax >= n.xmax and p.ymax >= n.ymax


def test_search_hits_just_the_overlapping_files(spark, indexed):
    rnd, files = random.Random(3), boxes(spark, indexed)
    for _ in range(4):
        x, y = rnd.uniform(0, 95), rnd.uniform(0, 45)
        box = (x, y, x + 6, y + 6)
        want = {f for f, b in files.items() if b[0] <= box[2] and b[2] >= box[0] and b[1] <= box[3] and b[3] >= box[1]}
        assert {r.file for r in rtree.hit_files(spark, indexed, box).collect()} == want
        got = layout.read_bbox(spark, indexed, box)
        assert {f.replace("file:///", "file:/") for f in got.inputFiles()} == want and len(want) < len(files) / 2
        assert {r[0] for r in got.select("_metadata.file_path").distinct().collect()} <= want
        plain = spark.read.parquet(indexed).where(geom.intersects_box("line", box))
        assert sorted(r.fid for r in got.collect()) == sorted(r.fid for r in plain.collect())
    nowhere = layout.read_bbox(spark, indexed, (500.0, 500.0, 501.0, 501.0))
    assert nowhere.count() == 0 and nowhere.columns == spark.read.parquet(indexed).columns


def test_one_file_and_files_without_boxes(spark):
    df = roads(spark, 30).where("line is not null and size(line) > 0")
    path = layout.write_covering_layout(df, scratch_path(spark, "rt"), num_files=1, file_rows=1000)
    assert layout.read_bbox(spark, path, (0.0, 0.0, 100.0, 60.0)).count() == df.count()
    path = scratch_path(spark, "rt")
    roads(spark, 300).withColumn("bbox", geom.bounds("line")).sort("fid").coalesce(1).write.option("maxRecordsPerFile", 1).parquet(path)
    rtree.build_index(spark, path, fanout=8)
    assert layout.read_bbox(spark, path, (-10.0, -10.0, 200.0, 200.0)).count() == roads(spark, 300).where("size(line) > 0").count()


@pytest.fixture(scope="module")
def archives(spark):
    root = scratch_path(spark, "archives")
    write_archives(spark, SF, root, features_per_archive=200)
    return root


def test_all_rows_equal_the_other_reader(spark, archives):
    keep = ["file_name", "member", "feature_no", "properties", "geom_type", "geometry", "srid"]
    a = mesh_archive.features_of(mesh_archive.scan_archives(spark, archives)).select(*keep)
    b = geojson.read_mesh_archives(spark, archives).select(*keep)
    rows = lambda d: sorted(((r.file_name, r.feature_no, repr(r)) for r in d.collect()))
    assert rows(a) == rows(b) and a.count() == 1500


def test_archives_ruled_out_by_name_stay_unopened(spark, archives):
    local = archives[len("file:"):] if archives.startswith("file:") else archives
    scan = lambda **kw: mesh_archive.scan_archives(spark, archives, **kw)
    whole = scan()
    total = whole.rdd.getNumPartitions()
    assert 0 < scan(meshes=["3622"]).rdd.getNumPartitions() < total
    counts = {r.source_mesh: r["count"] for r in whole.groupBy("source_mesh").count().collect()}
    with zipfile.ZipFile(f"{local}/N13-24_6441_GEOJSON_0000.zip", "w") as z:
        z.writestr("a.geojson", '{"type": "FeatureCollection", "features": []}')
        z.writestr("b.geojson", '{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": null}]}')
        z.writestr("c.xml", "<x/>")
    with open(f"{local}/N13-24_9999_GEOJSON_0000.zip", "wb") as f:      # can be listed, not opened
        f.write(b"not a zip")
    assert scan(meshes=["3622"]).count() == counts["3622"]
    assert scan(meshes=["3631", "5339"]).where("feature_no >= 0").count() == counts["3631"] + counts["5339"]
    assert scan(glob="N13-24_3724*").count() == counts["3724"] and scan(meshes=["1111"]).count() == 0
    assert scan(box=(139.2, 35.6, 139.3, 35.7)).count() == counts["5339"] and scan(box=(0, 0, 1, 1)).count() == 0
    two = scan(meshes=["6441"])
    assert two.rdd.getNumPartitions() == 2 and two.count() == 1
    with pytest.raises(Exception, match="zip"):
        scan().count()


def test_one_scan_used_twice_keeps_its_rows(spark, archives):
    """Filters of one use must not reach the other."""
    scan = mesh_archive.scan_archives(spark, archives, meshes=["3622", "3631", "5339"])
    counts = {r.source_mesh: r["count"] for r in scan.groupBy("source_mesh").count().collect()}
    a, b = scan.where("source_mesh = '3622'"), scan.where("source_mesh = '3631'")
    assert a.count() == counts["3622"] and scan.count() == sum(counts.values())
    assert a.union(b).count() == counts["3622"] + counts["3631"]
    assert a.join(b.select("feature_no"), "feature_no", "left_anti").count() + a.join(b.select("feature_no").distinct(), "feature_no").count() == a.count()


def test_cells_and_odd_names():
    assert mesh_archive.cell_of("5339") == (139.0, 53 / 1.5, 140.0, 54 / 1.5)
    x0, y0, x1, y1 = mesh_archive.cell_of("533946")
    assert (x0, x1) == (139.75, 139.875) and abs(y0 - (53 / 1.5 + 4 / 12)) < 1e-12 and abs(y1 - y0 - 1 / 12) < 1e-12
    assert mesh_archive.cell_of("53") is None and mesh_archive.cell_of("533989") is None and mesh_archive.cell_of(None) is None
    odd = mesh_archive.facts("/x/other.zip")
    assert odd["source_mesh"] is None and odd["cell_xmin"] is None and odd["file_name"] == "other.zip"
