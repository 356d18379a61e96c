"""GeoParquet writer (K3, S2) and WKB of both byte orders."""

from __future__ import annotations

import json
import os
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from road_rows import lines_df
from tsuji.functions import geom, wkb
from tsuji.operators import search
from tsuji.session import scratch_path
from tsuji.sinks import geoparquet, parts

ROWS = [("a", [(0, 0), (2, 3)]), ("b", [(5, -1), (6, 1), (7, 7)]), ("c", None), ("d", []), ("e", [(-4, 2), (1, 1)])]


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def files(path):
    return sorted(f for f in os.listdir(local(path)))


def roads(spark):
    return geom.with_srid(lines_df(spark, ROWS, "k string").repartition(3, "k"), "line", 6668)


def test_round_trip_box_and_key(spark):
    df = roads(spark)
    path = geoparquet.write_geoparquet(df, scratch_path(spark, "gp"), line="line")
    names = files(path)
    assert names and all(n.endswith(".parquet") for n in names)               # no staging folder is left
    boxes = []
    for n in names:
        meta = pq.read_metadata(f"{local(path)}/{n}")
        geo = json.loads(meta.metadata[b"geo"])
        column = geo["columns"][geo["primary_column"]]
        assert geo["version"] == "1.1.0" and column["encoding"] == "WKB" and column["geometry_types"] == ["LineString"]
        assert column["crs"]["id"] == {"authority": "EPSG", "code": 6668}
        assert column["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
        got = pq.read_table(f"{local(path)}/{n}").column("bbox").combine_chunks().to_pylist()
        got = [b for b in got if b]
        if got:
            assert column["bbox"] == [min(b["xmin"] for b in got), min(b["ymin"] for b in got),
                                      max(b["xmax"] for b in got), max(b["ymax"] for b in got)]
            boxes.append(column["bbox"])
        else:
            assert "bbox" not in column
    total = search.total_bounds_row(search.with_bbox(df))
    one = geoparquet.dataset_geo(spark, path).collect()
    assert len(one) == 1 and (one[0].column, one[0].srid, one[0].rows, one[0].files) == ("geometry", 6668, 5, len(names))
    assert tuple(one[0][n] for n in geoparquet.BOX) == tuple(total[n] for n in geoparquet.BOX) == (-4.0, -1.0, 7.0, 7.0)
    back = {r.k: r.geometry for r in parts.read_geoparquet(spark, path).collect()}
    want = {r.k: r.line for r in df.collect()}
    assert back == want


def test_append_overwrite_and_an_empty_table(spark):
    df = roads(spark)
    path = scratch_path(spark, "gp")
    geoparquet.write_geoparquet(df, path, line="line")
    n = len(files(path))
    geoparquet.write_geoparquet(df, path, line="line", mode="append")
    assert len(files(path)) == 2 * n and spark.read.parquet(path).count() == 10
    geoparquet.write_geoparquet(df.where("k = 'a'"), path, line="line")
    assert [r.k for r in spark.read.parquet(path).collect()] == ["a"]
    geoparquet.write_geoparquet(df.where("false"), path, line="line")
    assert spark.read.parquet(path).count() == 0 and len(files(path)) == 1
    assert geoparquet.dataset_geo(spark, path).first().rows == 0


def test_a_failed_write_leaves_the_old_files_only(spark):
    path = scratch_path(spark, "gp")
    geoparquet.write_geoparquet(roads(spark), path, line="line")
    before = files(path)
    bad = roads(spark).withColumn("k", F.when(F.col("k") == "e", F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="broken row"):
        geoparquet.write_geoparquet(bad, path, line="line")
    assert files(path) == before


def test_files_of_repeated_attempts_go(spark, tmp_path):
    schema = T.StructType([T.StructField("geometry", T.BinaryType()), T.StructField("bbox", geom.BBOX)])
    w = geoparquet.GeoWriter({"path": str(tmp_path / "t"), "geometry": "geometry", "covering": "bbox", "srid": "4326"}, schema, False)
    box = pa.array([dict(zip(geoparquet.BOX, (0.0, 1.0, 2.0, 3.0)))])
    batch = pa.RecordBatch.from_arrays([pa.array([b"x"]), box], names=["geometry", "bbox"])
    w.write(iter([batch]))                                                   # an attempt that Spark gave up
    done = w.write(iter([batch, batch]))
    idle = w.write(iter([]))
    assert idle.name == ""
    w.commit([done, idle, None])
    assert os.listdir(tmp_path / "t") == [done.name] and pq.read_metadata(tmp_path / "t" / done.name).num_rows == 2
    again = geoparquet.GeoWriter({"path": str(tmp_path / "t"), "geometry": "geometry", "covering": "bbox", "srid": "4326"}, schema, True)
    again.write(iter([batch]))
    again.abort([])
    again.abort([])
    assert os.listdir(tmp_path / "t") == [done.name]
    with pytest.raises(ValueError, match="EPSG:2451"):
        geoparquet.GeoWriter({"path": "x", "geometry": "g", "covering": "b", "srid": "2451"}, schema, True)


def test_wkb_of_either_byte_order(spark):
    def ring(order, pts):
        return struct.pack(f"{order}I", len(pts)) + b"".join(struct.pack(f"{order}dd", *p) for p in pts)

    def polygon(order, rings):
        return (b"\x01" if order == "<" else b"\x00") + struct.pack(f"{order}II", 3, len(rings)) + b"".join(ring(order, r) for r in rings)

    def multi(order, polygons):
        return (b"\x01" if order == "<" else b"\x00") + struct.pack(f"{order}II", 6, len(polygons)) + b"".join(polygons)

    shell, hole = [(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 0.5), (2, 0.5), (2, 1), (1, 0.5)]
    rows = [(1, polygon("<", [shell, hole])), (2, polygon(">", [shell, hole])), (3, multi("<", [polygon(">", [shell]), polygon("<", [hole])])),
            (4, multi(">", [])), (5, polygon("<", [])), (6, None)]
    df = spark.createDataFrame(rows, "k int, geometry binary").withColumn("m", wkb.multipolygon_from_wkb("geometry"))
    pts = lambda r: [(float(x), float(y)) for x, y in r]
    got = {r.k: None if r.m is None else [[[(p.x, p.y) for p in ring] for ring in poly] for poly in r.m] for r in df.collect()}
    assert got == {1: [[pts(shell), pts(hole)]], 2: [[pts(shell), pts(hole)]], 3: [[pts(shell)], [pts(hole)]], 4: [], 5: [], 6: None}
    back = {r.k: r.w and bytes(r.w) for r in df.select("k", wkb.multipolygon_to_wkb("m").alias("w")).collect()}
    assert back[1] == multi("<", [polygon("<", [shell, hole])]) and back[4] == back[5] == multi("<", []) and back[6] is None
    line = [(1.5, 2.0), (3.0, -4.0)]
    rows = [(k, (b"\x01" if o == "<" else b"\x00") + struct.pack(f"{o}I", 2) + ring(o, line)) for k, o in ((1, "<"), (2, ">"))] + [(3, None)]
    got = {r.k: r.g and [(p.x, p.y) for p in r.g] for r in spark.createDataFrame(rows, "k int, g binary").select("k", wkb.from_wkb("g").alias("g")).collect()}
    assert got == {1: line, 2: line, 3: None}
    with pytest.raises(Exception, match="unexpected WKB type 1|expected a LineString"):
        spark.createDataFrame([(b"\x00" + struct.pack(">I", 1),)], "g binary").select(wkb.from_wkb("g")).collect()
