"""Geometry Column functions on hand-made cases with known answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji.functions import geom


def _one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_crossing_line_intersects_box_without_a_vertex_inside(spark):
    df = lines_df(spark, [("a", [(0, 0.5), (2, 0.5)])])
    box = (0.5, 0.0, 1.5, 1.0)
    assert _one(df, geom.intersects_box("line", box)) == [True]
    # neither "a vertex inside" nor "bbox overlap" alone is the right test
    assert _one(df, F.exists("line", lambda p: (p["x"] >= 0.5) & (p["x"] <= 1.5))) == [False]


@pytest.mark.parametrize("coords,expected", [
    ([(0, 0), (1, 1)], True),           # the diagonal passes through the box
    ([(0, 2), (2, 0)], True),           # cuts the corner region diagonally through the box
    ([(1.5, 1), (3, 3)], True),         # touches the corner (boundary counts)
    ([(2, 0), (3, 1)], False),          # bbox overlaps? no
    ([(0, 1.2), (1.2, 0)], True),       # diagonal crossing the lower-left part
    ([(0, 0.55), (0.55, 0)], False),    # bboxes overlap but the line passes below the corner
    ([(0.7, 0.2), (0.8, 0.3)], True),   # fully inside
])
def test_intersects_cases(spark, coords, expected):
    df = lines_df(spark, [("a", coords)])
    assert _one(df, geom.intersects_box("line", (0.5, 0.1, 1.5, 1.0))) == [expected]


def test_bbox_read_case(spark):
    df = lines_df(spark, [("3622", [(0, 0), (1, 1)]), ("3622", [(1, 1), (2, 2)]), ("3631", [(5, 5), (6, 6)])])
    out = df.where(geom.intersects_box("line", (4.5, 4.5, 6.5, 6.5))).collect()
    assert [r.source_mesh for r in out] == ["3631"]


def _square(x0, y0, s):
    return [(x0, y0), (x0 + s, y0), (x0 + s, y0 + s), (x0, y0 + s), (x0, y0)]


def test_contains_point_interior_hole_and_boundary(spark):
    shell, hole = _square(0, 0, 4), _square(1, 1, 2)
    poly = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in (shell, hole)]]
    pts = [(0.5, 0.5, True), (2, 2, False), (1, 2, False), (0, 2, False), (4, 4, False), (3.5, 1.5, True), (5, 5, False)]
    df = spark.createDataFrame([(poly, float(x), float(y), e) for x, y, e in pts],
                               "mp array<array<array<struct<x:double,y:double>>>>, px double, py double, e boolean")
    for r in df.select(geom.contains_point("mp", "px", "py").alias("got"), "e").collect():
        assert r.got == r.e


def test_point_on_line(spark):
    df = lines_df(spark, [
        ("a", [(0, 0), (1, 0), (10, 0)]),          # one interior vertex -> it
        ("b", [(0, 0), (4, 0), (5, 0), (10, 0)]),  # centroid (5,0) -> vertex (5,0)
        ("c", [(0, 0), (2, 0)]),                   # no interior vertex -> first endpoint on a tie
        ("d", [(0, 0), (0, 0)]),                   # zero length
    ])
    p = geom.with_point_on_line(df, "line", "pt").select("source_mesh", "pt.x", "pt.y").collect()
    got = {r.source_mesh: (r.x, r.y) for r in p}
    assert got == {"a": (1.0, 0.0), "b": (5.0, 0.0), "c": (0.0, 0.0), "d": (0.0, 0.0)}
    # the single-column form agrees
    q = df.select("source_mesh", geom.point_on_line("line").alias("pt")).collect()
    assert {r.source_mesh: (r.pt.x, r.pt.y) for r in q} == got


def test_hilbert_visits_neighbouring_cells(spark):
    # 4x4 grid in the corner: cell centres at 0.5..3.5 over bounds 0..65535 cells
    from tsuji.functions.geom import HILBERT_MAX
    rows = [(float(x), float(y)) for x in range(4) for y in range(4)]
    df = spark.createDataFrame(rows, "x double, y double").select(
        "x", "y", geom.hilbert_distance(F.struct(F.col("x").alias("xmin"), F.col("y").alias("ymin"),
                                                 F.col("x").alias("xmax"), F.col("y").alias("ymax")),
                                        geom.envelope(0, 0, HILBERT_MAX, HILBERT_MAX)).alias("h"))
    cells = sorted((r.h, r.x, r.y) for r in df.collect())
    assert [c[0] for c in cells] == list(range(16))
    for (_, x1, y1), (_, x2, y2) in zip(cells, cells[1:]):
        assert abs(x1 - x2) + abs(y1 - y2) == 1


def test_wkt_roundtrip_and_parse(spark):
    df = spark.createDataFrame([("LINESTRING(139.70 35.65, 139.72 35.66)",), ("POINT(1 2)",)], "w string")
    got = [r[0] for r in df.select(geom.line_from_wkt("w")).collect()]
    assert [(p.x, p.y) for p in got[0]] == [(139.70, 35.65), (139.72, 35.66)]
    assert got[1] is None


def test_invalid_geometry_count_matches_reference_case(spark):
    from tsuji.operators.quality import count_invalid
    lines = lines_df(spark, [("good", [(0, 0), (1, 1)]), ("empty", []), ("missing", None),
                             ("degenerate", [(1, 1), (1, 1)])])
    assert count_invalid(lines, "line") == 3
    bowtie = [[[{"x": float(x), "y": float(y)} for x, y in [(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]]]]
    square = [[[{"x": float(x), "y": float(y)} for x, y in _square(0, 0, 1)]]]
    polys = spark.createDataFrame([(bowtie,), (square,), ([],), (None,)],
                                  "g array<array<array<struct<x:double,y:double>>>>")
    assert count_invalid(polys, "g", polygon=True) == 3
    clean = lines_df(spark, [("a", [(0, 0), (1, 1)]), ("b", [(1, 1), (2, 0)])])
    assert count_invalid(clean, "line") == 0


def test_to_multipolygon(spark):
    ring = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 1.0}, {"x": 0.0, "y": 0.0}]
    schema = "t string, p array<array<struct<x:double,y:double>>>, m array<array<array<struct<x:double,y:double>>>>"
    df = spark.createDataFrame([("Polygon", [ring], None), ("MultiPolygon", None, [[ring], [ring]]),
                                ("Polygon", [], None), (None, None, None)], schema)
    got = [r[0] for r in df.select(geom.to_multipolygon("t", "p", "m")).collect()]
    assert [None if g is None else len(g) for g in got] == [1, 2, None, None]
    bad = spark.createDataFrame([("LineString", None, None)], schema)
    with pytest.raises(Exception, match="unexpected geometry type"):
        bad.select(geom.to_multipolygon("t", "p", "m")).collect()


def test_crs_metadata(spark):
    df = lines_df(spark, [("a", [(0, 0), (1, 1)])])
    assert geom.srid_of(df, "line") is None
    assert geom.srid_of(geom.with_srid(df, "line", 6668), "line") == 6668
    with pytest.raises(ValueError):
        geom.transform_crs("line", 6668, 3857)


def test_accessors_and_flip(spark):
    df = lines_df(spark, [("a", [(1, 2), (3, 4), (5, 6)])])
    r = df.select(geom.num_points("line").alias("n"), geom.point_n("line", 2).alias("p2"),
                  geom.point_n("line", -1).alias("pn"), geom.flip("line").alias("f")).first()
    assert r.n == 3 and (r.p2.x, r.p2.y) == (3, 4) and (r.pn.x, r.pn.y) == (5, 6)
    assert [(p.x, p.y) for p in r.f] == [(2, 1), (4, 3), (6, 5)]
