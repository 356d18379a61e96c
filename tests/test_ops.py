"""Duplicates, normalise/transform/checks/upsert, parts and merge, layout, grid join, ids, archives."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji.functions import geom
from tsuji.operators import ids, quality, spatial_join, warehouse
from tsuji.session import current
from tsuji.sinks import layout, parts
from tsuji.sources import geojson


def _tmp():
    return tempfile.mkdtemp(prefix="tsuji-test-", dir="/tmp")


# ---------------------------------------------------------------- duplicates
def test_a_line_delivered_by_two_meshes_is_reported_in_both(spark):
    seam = [(140.0, 36.5), (140.0, 36.625), (140.125, 36.75)]
    rows = [("A1", seam), ("A1", seam[:2]), ("B2", seam), ("B2", [(139.5, 36.0), (139.5, 36.25)]), ("C3", seam)]
    got = quality.cross_mesh_duplicates(lines_df(spark, rows))
    assert sorted(r.source_mesh for r in got.collect()) == ["A1", "B2", "C3"] and got.columns == ["source_mesh", "line"]


def test_repeats_within_a_mesh_reversals_and_signed_zeros_are_no_duplicates(spark):
    rows = [("A1", [(3.5, 7.0), (4.0, 7.5)]), ("A1", [(3.5, 7.0), (4.0, 7.5)]), ("B2", [(4.0, 7.5), (3.5, 7.0)]),
            ("A1", [(0.0, 5.0), (2.0, 5.0)]), ("B2", [(-0.0, 5.0), (2.0, 5.0)]), ("A1", None), ("B2", None)]
    assert quality.cross_mesh_duplicates(lines_df(spark, rows)).count() == 0
    assert quality.cross_mesh_duplicates(lines_df(spark, rows[:0])).count() == 0
    same = [("A1", [(-0.0, 5.0), (2.0, 5.0)]), ("B2", [(-0.0, 5.0), (2.0, 5.0)])]
    assert quality.cross_mesh_duplicates(lines_df(spark, same)).count() == 2


# ---------------------------------------------------------------- normalise / transform
def test_normalize_renames_tags_and_keeps_unknown(spark):
    df = spark.createDataFrame([("2018-10-05", "2", "362257", 1, "N13-24_3622_GEOJSON.zip"),
                                ("2019-01-01", "3", "362258", 2, "n13-24_3622_geojson.zip")],
                               "N13_001 string, N13_002 string, N13_008 string, extra_col int, f string")
    out = warehouse.normalize_roads(df, file_col="f")
    assert {"registration_date", "road_type", "secondary_mesh_code", "extra_col"} <= set(out.columns)
    assert "N13_002" not in out.columns
    assert [r.source_mesh for r in out.collect()] == ["3622", "3622"]
    assert warehouse.normalize_roads(df, mesh="3631").select("source_mesh").distinct().first()[0] == "3631"


def test_mesh_code_missing_is_an_error(spark):
    df = spark.createDataFrame([("roads.zip",)], "f string")
    with pytest.raises(Exception, match="no mesh code"):
        warehouse.normalize_roads(df, file_col="f").collect()


def _stage(spark, road_type="1"):
    from tsuji.functions.geom import LINE
    from pyspark.sql import types as T
    import datetime as dt
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("road_type", "road_classification", "road_status", "width_category", "toll_category")]
                          + [T.StructField("registration_date", T.TimestampNTZType()),
                             T.StructField("layer_order", T.IntegerType()),
                             T.StructField("source_mesh", T.StringType()), T.StructField("secondary_mesh_code", T.StringType()),
                             T.StructField("geometry", LINE)])
    line = [{"x": 139.70, "y": 35.65}, {"x": 139.72, "y": 35.66}]
    rows = [(road_type, "1", "1", "3", "2", dt.datetime(2024, 9, 1), 0, "5339", "533946", line),
            ("3", "2", "2", "2", "1", dt.datetime(2024, 9, 1), 1, "5235", "523504", line)]
    return geom.with_srid(spark.createDataFrame(rows, schema), "geometry", 6668)


def test_typed_projection_and_checks(spark):
    typed = warehouse.typed_roads(_stage(spark))
    assert dict(typed.dtypes)["road_type"] == "smallint" and dict(typed.dtypes)["registration_date"] == "date"
    assert geom.srid_of(typed, "line") == 4326
    v = {r.check: r.violations for r in warehouse.constraint_violations(spark, typed, key=["source_mesh"]).collect()}
    assert sum(v.values()) == 0
    bad = warehouse.typed_roads(_stage(spark, road_type="9"))
    v = {r.check: r.violations for r in warehouse.constraint_violations(spark, bad, key=["source_mesh"]).collect()}
    assert v["foreign_key:road_type"] == 1


def test_typed_cast_rejects_fractional_code(spark):
    with pytest.raises(Exception):
        warehouse.typed_roads(_stage(spark, road_type="1.5")).collect()


def test_transform_refuses_to_replace_table_on_violation(spark):
    path = os.path.join(_tmp(), "roads")
    stage = _stage(spark).withColumn("fid", F.monotonically_increasing_id())
    assert warehouse.transform(spark, stage, path) == 2
    with pytest.raises(warehouse.ConstraintError):
        warehouse.transform(spark, _stage(spark, road_type="9").withColumn("fid", F.lit(1)), path)
    assert spark.read.parquet(current(spark, path)).count() == 2


def test_a_failed_write_leaves_the_old_table(spark):
    path = os.path.join(_tmp(), "roads")
    stage = _stage(spark)
    assert warehouse.transform(spark, stage, path) == 2
    before = sorted(map(str, spark.read.parquet(current(spark, path)).collect()))
    broken = stage.withColumn("secondary_mesh_code", F.when(F.col("source_mesh") == "5339", F.raise_error(F.lit("lost"))).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        warehouse.transform(spark, broken, path)
    assert sorted(map(str, spark.read.parquet(current(spark, path)).collect())) == before
    assert warehouse.transform(spark, stage.limit(1), path) == 1          # a later run replaces it
    assert spark.read.parquet(current(spark, path)).count() == 1


def test_identity_key_is_dense_and_repeatable(spark):
    path = os.path.join(_tmp(), "roads")
    warehouse.transform(spark, _stage(spark).repartition(3), path)
    got = [(r.fid, r.source_mesh) for r in spark.read.parquet(current(spark, path)).orderBy("fid").collect()]
    assert got == [(1, "5235"), (2, "5339")]


def test_upsert(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "code int, label string")
    n = spark.createDataFrame([(2, "B"), (3, "c")], "code int, label string")
    assert sorted(tuple(r) for r in warehouse.upsert(t, n, ["code"]).collect()) == [(1, "a"), (2, "B"), (3, "c")]


# ---------------------------------------------------------------- parts and merge
def _write_part(spark, root, mesh, coords_list):
    df = lines_df(spark, [(mesh, c) for c in coords_list])
    parts.write_parts(df, root)


def test_merge_preserves_count_and_is_rerunnable(spark):
    root = _tmp()
    _write_part(spark, f"{root}/parts", "3622", [[(0, 0), (1, 1)], [(1, 1), (2, 2)]])
    _write_part(spark, f"{root}/parts", "3631", [[(2, 2), (3, 3)]])
    paths = parts.part_paths(spark, f"{root}/parts")
    assert len(paths) == 2
    for _ in range(2):      # rerun: overwrite, never append
        merged = parts.merge_parts(spark, paths, base_path=f"{root}/parts")
        assert parts.write_counted(merged, f"{root}/merged", "m") == 3
    out = spark.read.parquet(f"{root}/merged")
    assert out.count() == 3 and {r[0] for r in out.select("source_mesh").distinct().collect()} == {"3622", "3631"}
    # rewriting one mesh replaces only that mesh
    _write_part(spark, f"{root}/parts", "3631", [[(2, 2), (3, 3)]])
    assert parts.merge_parts(spark, parts.part_paths(spark, f"{root}/parts"), base_path=f"{root}/parts").count() == 3


def test_merge_errors(spark):
    with pytest.raises(ValueError, match="empty list"):
        parts.merge_parts(spark, [])
    root = _tmp()
    spark.createDataFrame([(1, 1.5)], "a int, b double").write.parquet(f"{root}/p1")
    spark.createDataFrame([(1, 2.5)], "a int, c double").write.parquet(f"{root}/p2")
    with pytest.raises(ValueError):
        parts.merge_parts(spark, [f"{root}/p1", f"{root}/p2"])
    spark.createDataFrame([(1.5, 1.0)], "a double, b double").write.parquet(f"{root}/p3")
    with pytest.raises(Exception, match="unsafe cast"):
        parts.merge_parts(spark, [f"{root}/p1", f"{root}/p3"]).collect()


def test_reconcile():
    parts.reconcile({"a": 3, "b": 3})
    with pytest.raises(RuntimeError):
        parts.reconcile({"a": 3, "b": 2})


# ---------------------------------------------------------------- layout and bbox read
def test_covering_layout_prunes_and_reads_exactly(spark):
    rows = [(f"{i}", [(139 + (i % 50) * 0.01, 35 + (i // 50) * 0.01), (139.005 + (i % 50) * 0.01, 35.005 + (i // 50) * 0.01)])
            for i in range(2500)]
    df = lines_df(spark, rows, "fid string").withColumn("fid", F.col("fid").cast("long"))
    path = os.path.join(_tmp(), "sorted")
    layout.write_covering_layout(df, path, num_files=2, row_group_rows=100)
    box = (139.1, 35.1, 139.13, 35.13)
    got = layout.read_bbox(spark, path, box)
    exp = df.where(geom.intersects_box("line", box))
    assert sorted(r.fid for r in got.collect()) == sorted(r.fid for r in exp.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "bbox.xmin" in plan and "PushedFilters" in plan
    layout.write_covering_layout(df, path, num_files=2, row_group_rows=100)
    assert spark.read.parquet(path).count() == 2500


# ---------------------------------------------------------------- grid join
def test_grid_join_equals_brute_force(spark):
    def sq(x0, y0, s):
        return [{"x": float(x), "y": float(y)} for x, y in [(x0, y0), (x0 + s, y0), (x0 + s, y0 + s), (x0, y0 + s), (x0, y0)]]
    polys = spark.createDataFrame([(1, [[sq(0, 0, 1)]]), (2, [[sq(1, 0, 1)]]), (3, [[sq(0, 1, 2), sq(0.5, 1.5, 0.5)]])],
                                  "gid long, mpoly array<array<array<struct<x:double,y:double>>>>")
    pts = spark.createDataFrame([(i, (i % 23) * 0.1, (i // 23) * 0.1) for i in range(23 * 31)], "fid long, px double, py double")
    got = {(r.fid, r.gid) for r in spatial_join.points_in_polygons(pts, polys, cell=0.3).collect()}
    brute = {(r.fid, r.gid) for r in pts.crossJoin(polys).where(geom.contains_point("mpoly", "px", "py")).collect()}
    assert got == brute and len(got) > 0
    # points on the shared edge x = 1.0 (y < 1) of polygons 1 and 2 belong to neither
    hits = spatial_join.points_in_polygons(pts, polys, cell=0.3).collect()
    assert not any(r.px == 1.0 and r.py < 1.0 for r in hits)
    assert any(r.px == 1.0 and 1.0 < r.py < 1.5 and r.gid == 3 for r in hits)


# ---------------------------------------------------------------- ids
def test_dense_id_is_dense_and_deterministic(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    a = ids.dense_id(df, ["k"], num_partitions=7)
    rows = sorted((r.k, r.id) for r in a.collect())
    assert [r[1] for r in rows] == list(range(1, 1001))
    assert rows == sorted((r.k, r.id) for r in ids.dense_id(df, ["k"], num_partitions=3).collect())


# ---------------------------------------------------------------- archives
def test_archive_roundtrip_and_errors(spark):
    root = _tmp()
    src = lines_df(spark, [("3622", [(0, 0), (1, 1)]), ("3622", [(1, 1), (2, 2)]), ("3631", [(5, 5), (6, 6)])],
                   "mesh string").withColumn("fid", F.monotonically_increasing_id()) \
        .withColumn("N13_002", F.lit("2")).withColumnRenamed("line", "geometry")
    assert geojson.write_mesh_archives(src, root, features_per_archive=1).count() == 3
    feats = geojson.read_mesh_archives(spark, root)
    out = warehouse.normalize_roads(feats, file_col="file_name")
    got = sorted((r.source_mesh, r.road_type, r.srid) for r in out.collect())
    assert got == [("3622", "2", 6668), ("3622", "2", 6668), ("3631", "2", 6668)]
    assert geom.srid_of(feats, "geometry") == 6668 and "fid" in feats.columns
    names = {"": 4326, "urn:ogc:def:crs:EPSG::6668": 6668, "urn:ogc:def:crs:EPSG:6.9:6668": 6668, "EPSG:4326": 4326,
             "http://www.opengis.net/def/crs/EPSG/0/6668": 6668, "urn:ogc:def:crs:OGC:1.3:CRS84": 4326, "OGC:CRS84": 4326, "local": -1}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    assert {r.n: r.s for r in df.select("n", geojson.srid_column(F.col("n")).alias("s")).collect()} == names
    assert {k: geojson.srid_of_name(k) for k in names} == names
    pick = geojson.data_member
    assert pick(["meta.json", "b.GeoJSON", "a.geojson"], "x") == "b.GeoJSON" and pick(["readme.txt", "z.json", "a.json"], "x") == "z.json"
    for members in (["a.shp", "a.dbf"], ["readme.txt"], []):
        with pytest.raises(geojson.ConvertError, match="x.zip"):
            pick(members, "x.zip")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.txt", "x")
    assert zipfile.ZipFile(io.BytesIO(buf.getvalue())).namelist() == ["a.txt"]


def test_text_stage_becomes_a_typed_table(spark):
    rows = [(f"{1 + i % 5}", f"{1 + i % 6}", f"{1 + i % 7}", f"{1 + i % 6}", f"{1 + i % 2}", f"20{10 + i}-0{1 + i % 9}-15", i % 3 - 1, f"{60 + i}00", f"{60 + i}00{i:02d}",
             f"LINESTRING({130 + i / 8} {30 + i / 16}, {130.5 + i / 8} {30.25 + i / 16})") for i in range(12)]
    names = ["road_type", "road_classification", "road_status", "width_category", "toll_category", "d", "layer_order", "source_mesh",
             "secondary_mesh_code", "wkt"]
    stage = (spark.createDataFrame(rows, names).withColumn("layer_order", F.col("layer_order").cast("int"))
             .withColumn("registration_date", F.to_timestamp("d")).withColumn("geometry", geom.line_from_wkt("wkt")).drop("d", "wkt"))
    path = os.path.join(_tmp(), "roads")
    assert warehouse.transform(spark, geom.with_srid(stage, "geometry", 6668), path) == 12
    out = spark.read.parquet(current(spark, path))
    assert [(r.fid, r.road_type, str(r.registration_date)) for r in out.orderBy("source_mesh").collect()] == [
        (i + 1, 1 + i % 5, f"20{10 + i}-0{1 + i % 9}-15") for i in range(12)]
    assert geom.srid_of(out, "line") == 4326 and dict(out.dtypes)["layer_order"] == "smallint"


def test_incremental_ingest_skips_done_archives(spark):
    from tsuji.sinks.partitioned import read_partitions_as_text
    from tsuji.streaming.ingest import incremental_ingest

    root = _tmp()
    first = lines_df(spark, [("3622", [(0, 0), (1, 1)]), ("3622", [(1, 1), (2, 2)])], "mesh string") \
        .withColumn("fid", F.monotonically_increasing_id()).withColumn("N13_002", F.lit("1")) \
        .withColumnRenamed("line", "geometry")
    geojson.write_mesh_archives(first, f"{root}/landing").count()
    incremental_ingest(spark, f"{root}/landing", f"{root}/table", f"{root}/ckpt")
    assert read_partitions_as_text(spark, f"{root}/table").count() == 2
    # a new archive lands; the rerun ingests only it
    second = lines_df(spark, [("3631", [(5, 5), (6, 6)])], "mesh string") \
        .withColumn("fid", F.lit(99).cast("long")).withColumn("N13_002", F.lit("2")) \
        .withColumnRenamed("line", "geometry")
    geojson.write_mesh_archives(second, f"{root}/landing").count()
    incremental_ingest(spark, f"{root}/landing", f"{root}/table", f"{root}/ckpt")
    t = read_partitions_as_text(spark, f"{root}/table")
    assert t.count() == 3
    assert sorted(r[0] for r in t.groupBy("source_mesh").count().select("source_mesh").collect()) == ["3622", "3631"]
    # nothing new: a third run adds nothing
    incremental_ingest(spark, f"{root}/landing", f"{root}/table", f"{root}/ckpt")
    assert read_partitions_as_text(spark, f"{root}/table").count() == 3


def test_lead_by_window_equals_array_successor(spark):
    from tsuji.plans.analysis import lead_by_window, vertices
    df = lines_df(spark, [("a", [(0, 0), (1, 1), (2, 0)]), ("b", [(5, 5), (6, 6)])], "fid string")
    v = vertices(df)
    w = lead_by_window(v.select("fid", "i", "pt"), "fid", "i", "pt", "nxt")
    got = {(r.fid, r.i): r.nxt for r in w.collect()}
    exp = {(r.fid, r.i): r.next_pt for r in v.collect()}
    assert got == exp


def test_unzipped_geojson_reader_matches_archive_reader(spark):
    root = _tmp()
    src = lines_df(spark, [("3622", [(0, 0), (1, 1)]), ("3622", [(1, 1), (2, 2), (3, 1)]), ("3631", [(5, 5), (6, 6)])],
                   "mesh string").withColumn("fid", F.monotonically_increasing_id()) \
        .withColumn("N13_002", F.lit("2")).withColumn("N13_005", F.lit("-1")).withColumnRenamed("line", "geometry")
    geojson.write_mesh_archives(src, f"{root}/zips").count()
    os.makedirs(f"{root}/plain")
    for z in os.listdir(f"{root}/zips"):
        with zipfile.ZipFile(f"{root}/zips/{z}") as zf:
            for m in zf.namelist():
                if m.endswith(".geojson"):
                    with open(f"{root}/plain/{m}", "wb") as fh:
                        fh.write(zf.read(m))
    cols = ["N13_002", "N13_005", "geom_type", "geometry", "srid"]
    a = sorted(str(tuple(r)) for r in geojson.read_mesh_archives(spark, f"{root}/zips").select(*cols).collect())
    b = sorted(str(tuple(r)) for r in geojson.read_geojson_files(spark, f"{root}/plain").select(*cols).collect())
    assert a == b and len(a) == 3
    names = {r.source_mesh for r in warehouse.normalize_roads(
        geojson.read_geojson_files(spark, f"{root}/plain"), file_col="file_name").select("source_mesh").collect()}
    assert names == {"3622", "3631"}


def test_geo_metadata_roundtrip(spark):
    root = _tmp()
    df = geom.with_srid(lines_df(spark, [("3622", [(139.0, 35.0), (139.5, 35.2)]), ("3631", [(140.0, 36.0), (140.1, 36.5)])]),
                        "line", 6668)
    meta = parts.write_geo_metadata(spark, df, f"{root}/geo")
    back = parts.read_geo_metadata(spark, f"{root}/geo")
    assert back == meta
    col = back["columns"]["line"]
    assert col["bbox"] == [139.0, 35.0, 140.1, 36.5]            # the union of all rows, not the first part's
    assert col["crs"]["id"]["code"] == 6668


def test_band_index_equals_full_ray_cast_on_detailed_polygons(spark):
    import math
    def ring(cx, cy, r, n, step=1):
        pts = [{"x": cx + r * math.cos(2 * math.pi * k / n), "y": cy + r * math.sin(2 * math.pi * k / n)}
               for k in range(0, n, step)]
        return pts + [pts[0]]
    circle = [[ring(0.0, 0.0, 1.0, 2000), ring(0.2, 0.1, 0.3, 500)]]          # shell with a hole
    square = [[[{"x": 1.0, "y": -0.5}, {"x": 2.0, "y": -0.5}, {"x": 2.0, "y": 0.5}, {"x": 1.0, "y": 0.5},
                {"x": 1.0, "y": -0.5}]]]
    polys = spark.createDataFrame([(1, circle), (2, square)],
                                  "gid long, mpoly array<array<array<struct<x:double,y:double>>>>")
    pts = spark.createDataFrame([(i, -1.2 + (i % 71) * 0.047, -1.2 + (i // 71) * 0.034) for i in range(71 * 71)],
                                "fid long, px double, py double")
    got = {(r.fid, r.gid) for r in spatial_join.points_in_polygons(pts, polys, cell=0.25).collect()}
    brute = {(r.fid, r.gid) for r in pts.crossJoin(polys).where(geom.contains_point("mpoly", "px", "py")).collect()}
    assert got == brute and len(got) > 1000


def _walk(text):
    return list(geojson.iter_features(lambda: io.StringIO(text)))


@pytest.mark.parametrize("layout", geojson.LAYOUTS)
def test_every_layout_gives_every_feature(layout, monkeypatch):
    import json as _json

    feats = [{"type": "Feature", "properties": {"a": i, "t": 'x"]},{ \\ é\n'}, "geometry": {"type": "LineString", "coordinates": [[0, i], [1.5e0, -i]]}}
             for i in range(7)]
    crs = {"type": "name", "properties": {"name": "EPSG:6668"}}
    for size in (1, 7, 1 << 20):                       # the buffer may end anywhere
        monkeypatch.setattr(geojson, "READ_CHARS", size)
        for c in (crs, None):
            got = _walk(geojson.collection_text({"type": "FeatureCollection", "name": "n"}, c, feats, layout))
            assert [_json.loads(f) for f, _ in got] == feats
            assert {n for _, n in got} == {"EPSG:6668" if c else None}


def test_odd_collections():
    assert _walk('{"features": []}') == [] and _walk("{}") == [] and _walk(' {"features" : null , "x":1} ') == []
    assert [c for _, c in _walk('{"features":[{}],"crs":{"properties":{"name":"n"}}}')] == ["n"]
    for broken in ("", "[]", '{"features":[{}', '{"features":[{}]', '{"features":[{} {}]}', '{"features":[{}]} x', '{"features":[{]}'):
        with pytest.raises((geojson.ConvertError, ValueError)):
            _walk(broken)


def test_grid_join_with_one_polygon_over_everything(spark):
    sq = lambda x, y, s: [[[{"x": float(a), "y": float(b)} for a, b in [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]]]
    rows = [(i, sq(i % 20, i // 20, 0.75)) for i in range(400)] + [(1000, sq(-500, -500, 2000)), (1001, sq(3, 3, 7))]
    polys = spark.createDataFrame(rows, "gid long, mpoly array<array<array<struct<x:double,y:double>>>>")
    pts = spark.createDataFrame([(i, (i % 61) / 3, (i // 61) / 3) for i in range(61 * 61)], "fid long, px double, py double")
    cells = spatial_join.polygon_cells(polys, 1.0)
    assert cells.groupBy("gid").count().agg(F.max("count")).first()[0] <= 9
    got = {(r.fid, r.gid) for r in spatial_join.points_in_polygons(pts, polys, cell=1.0).collect()}
    brute = {(r.fid, r.gid) for r in pts.crossJoin(polys).where(geom.contains_point("mpoly", "px", "py")).collect()}
    assert got == brute and len({g for _, g in got}) > 390
    missed = spatial_join.points_in_polygons(pts, polys.where("gid = 1001"), cell=1.0, keep_misses=True)
    assert missed.where("gid is null").count() == 61 * 61 - len([1 for _, g in brute if g == 1001])


def test_wkb_parquet_is_read_into_the_native_form(spark):
    df = lines_df(spark, [("a", [(1, 2), (3, 4)]), ("b", None)]).withColumnRenamed("line", "geometry")
    path = parts.write_wkb(df, f"{_tmp()}/wkb")
    assert dict(spark.read.parquet(path).dtypes)["geometry"] == "binary"
    back = parts.read_geoparquet(spark, path, srid=6668)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.select(*back.columns).collect())) and geom.srid_of(back, "geometry") == 6668


def test_fetch_worklist_skips_existing_non_empty_files(spark):
    from tsuji.sources import fetch
    root = _tmp()
    with open(f"{root}/a.zip", "wb") as fh:
        fh.write(b"x" * 10)                       # done: exists with size > 0
    open(f"{root}/b.zip", "wb").close()           # empty: fetched again
    urls = spark.createDataFrame([(1, "https://h/p/a.zip"), (2, "https://h/q/b.zip"), (3, "https://h/c.zip?x=1"),
                                  (4, "https://h/r/c.zip")], "page_id long, url string")
    got = {(r.page_id, r.name) for r in fetch.worklist(urls, fetch.listing(spark, root)).collect()}
    assert got == {(2, "b.zip"), (3, "c.zip")}    # c.zip once, the first URL in order
    bad = spark.createDataFrame([(1, "https://h/")], "page_id long, url string")
    with pytest.raises(Exception, match="without a file name"):
        fetch.worklist(bad, fetch.listing(spark, root)).collect()
