"""Point-in-polygon join through a grid of several levels.

``ST_Contains(poly, ST_PointOnSurface(line))`` as a plain theta join would plan a nested loop.
Instead every polygon lists the few cells its bbox touches on the grid level that fits its own
extent, every point has one cell per level in use, and the join is an equi join on (level, cell).
A strict bbox test follows, then an equi join on (polygon id, band) for the exact test.

Scale notes:
* a polygon touches at most 3 x 3 cells of its level, whatever its size: a country among villages
  costs nine rows, not millions; the levels in use are a handful (cell sizes are powers of two);
* the cell table holds ``(level, cx, cy, gid, bbox, band height)`` only, not the rings;
* the exact test joins on ``(gid, band)`` to the edges overlapping that band; band heights follow the
  polygon's number of edges, so a detailed coast line has many bands of about ``BAND_EDGES`` edges;
* both joins are left to AQE: the small side is broadcast when its *measured* size is under the
  threshold, otherwise a sort-merge join whose skewed partitions (a hot cell or a hot polygon
  holding a third of all roads) are split by the skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geom


def default_cell_size(polys: DataFrame, mpoly: str = "mpoly") -> float:
    """Median of the polygons' larger bbox side (one approximate-percentile aggregate)."""
    b = geom.bounds(geom.polygon_vertices(mpoly))
    side = F.greatest(b["xmax"] - b["xmin"], b["ymax"] - b["ymin"])
    v = polys.select(F.percentile_approx(side, 0.5, 10000).alias("m")).first()["m"]
    return float(v) if v and v > 0 else 1.0


BAND_EDGES = 64


def _edges(mpoly: str) -> Column:
    return F.flatten(F.transform(F.flatten(F.col(mpoly)), lambda r: F.arrays_zip(
        F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))).alias("a"),
        F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))).alias("b"))))


def _band_height(bbox: Column, edges: Column) -> Column:
    """Band height of a polygon: its extent over its share of bands, 1 for a flat one."""
    h = (bbox["ymax"] - bbox["ymin"]) / F.ceil((F.size(edges) + 1) / F.lit(BAND_EDGES))
    return F.when(h > 0, h).otherwise(F.lit(1.0))


def polygon_cells(polys: DataFrame, base: float, key: str = "gid", mpoly: str = "mpoly") -> DataFrame:
    """(level, cx, cy, key, pb, h): the cells of side ``base * 2^level`` that a polygon's bbox ``pb``
    touches, on the lowest level whose cells are at least as large as the polygon."""
    b = geom.bounds(geom.polygon_vertices(mpoly))
    p = polys.select(key, b.alias("pb"), _band_height(b, _edges(mpoly)).alias("h"))
    side = F.greatest(F.col("pb.xmax") - F.col("pb.xmin"), F.col("pb.ymax") - F.col("pb.ymin"))
    p = p.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(side, F.lit(base)) / base))).cast("int"))
    c = F.lit(float(base)) * F.pow(F.lit(2.0), F.col("level"))
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(f"pb.{lo}") / c), F.floor(F.col(f"pb.{hi}") / c)))
    return (p.select("level", key, "pb", "h", cells("xmin", "xmax").alias("cx"))
            .select("level", "cx", cells("ymin", "ymax").alias("cy"), key, "pb", "h"))


def polygon_bands(polys: DataFrame, key: str = "gid", mpoly: str = "mpoly") -> DataFrame:
    """(key, band, edges): the edges of all rings of a polygon whose y-range overlaps the band.

    A horizontal ray at ``y = py`` can only cross (or contain the point on) an edge whose y-range
    contains ``py``, and every such edge overlaps the point's band, so testing a point against its
    band's edges gives exactly the same answer as testing all edges."""
    b = geom.bounds(geom.polygon_vertices(mpoly))
    p = polys.select(key, b["ymin"].alias("y0"), _edges(mpoly).alias("edges"), b.alias("pb"))
    p = p.select(key, "y0", _band_height(F.col("pb"), F.col("edges")).alias("h"), F.explode("edges").alias("e"))
    at = lambda f: F.floor((f(F.col("e.a.y"), F.col("e.b.y")) - F.col("y0")) / F.col("h"))
    return (p.select(key, "e", F.explode(F.sequence(at(F.least), at(F.greatest))).alias("band"))
            .groupBy(key, "band").agg(F.collect_list("e").alias("edges")))


def grid_levels(cells: DataFrame) -> list[int]:
    """The grid levels in use: a few small numbers."""
    return sorted(r[0] for r in cells.select("level").distinct().collect())


def contains_point_edges(edges, px, py) -> Column:
    """Interior test against a flat edge list (shell and hole edges of disjoint polygons together):
    even-odd crossings of the ray to +x, and false when the point lies on an edge. For a valid
    multipolygon (parts do not overlap) this equals "inside one of its polygons"."""
    px, py = F.col(px) if isinstance(px, str) else px, F.col(py) if isinstance(py, str) else py

    def step(acc, e):
        a, b = e["a"], e["b"]
        cross = ((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"])
        side = (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])
        on = ((side == 0) & (px >= F.least(a["x"], b["x"])) & (px <= F.greatest(a["x"], b["x"]))
              & (py >= F.least(a["y"], b["y"])) & (py <= F.greatest(a["y"], b["y"])))
        return F.struct(F.when(cross, acc["n"] + 1).otherwise(acc["n"]).alias("n"), (acc["on"] | on).alias("on"))

    e = F.col(edges) if isinstance(edges, str) else edges
    return F.aggregate(e, F.struct(F.lit(0).alias("n"), F.lit(False).alias("on")), step,
                       lambda acc: ((acc["n"] % 2) == 1) & ~acc["on"])


def points_in_polygons(points: DataFrame, polys: DataFrame, *, px: str = "px", py: str = "py",
                       key: str = "gid", mpoly: str = "mpoly", cell: float | None = None,
                       cells: DataFrame | None = None, bands: DataFrame | None = None,
                       levels: list[int] | None = None, keep_misses: bool = False) -> DataFrame:
    """Inner join of points to the polygon that strictly contains them (boundary is outside).

    Returns the point columns plus ``key`` and the polygons' other attributes; points matching no
    polygon drop out. With ``keep_misses`` every point has at least one row, with a null ``key``
    where a level or candidate gave no match. ``cells``, ``bands`` and ``levels`` may be passed in
    when they were built once for a polygon table (same ``cell``)."""
    base = float(cell or default_cell_size(polys, mpoly))
    cells = cells if cells is not None else polygon_cells(polys, base, key, mpoly)
    bands = bands if bands is not None else polygon_bands(polys, key, mpoly)
    levels = (levels if levels is not None else grid_levels(cells)) or [0]
    how = "left" if keep_misses else "inner"
    pts = points.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])))
    side = F.lit(base) * F.pow(F.lit(2.0), F.col("level"))
    # non-nullable cell keys: no inferred IS NOT NULL filter that would re-evaluate the point expression
    for c, v in (("cx", px), ("cy", py)):
        pts = pts.withColumn(c, F.coalesce(F.floor(F.col(v) / side), F.lit(-(2 ** 62))))
    # strict bbox test with the cell join (plain comparisons, codegen'd): interior points lie
    # strictly inside the polygon's bbox, so most grid candidates never reach the ray cast
    b = F.col("pb")
    inside_box = (F.col(px) > b["xmin"]) & (F.col(px) < b["xmax"]) & (F.col(py) > b["ymin"]) & (F.col(py) < b["ymax"])
    same = (pts["level"] == cells["level"]) & (pts["cx"] == cells["cx"]) & (pts["cy"] == cells["cy"])
    cand = pts.join(cells, same & inside_box, how).select(
        *points.columns, F.col(key).alias("_cand"), F.floor((F.col(py) - F.col("pb.ymin")) / F.col("h")).alias("_band"))
    # exact test against the edges of the point's band only
    rows = cand.join(bands, (F.col("_cand") == bands[key]) & (F.col("_band") == bands["band"]), how)
    hit = contains_point_edges("edges", px, py)
    if keep_misses:
        rows = rows.select(*points.columns, F.when(F.coalesce(hit, F.lit(False)), F.col("_cand")).alias(key))
    else:
        rows = rows.where(hit).select(*points.columns, F.col("_cand").alias(key))
    attrs = [c_ for c_ in polys.columns if c_ not in (key, mpoly)]
    return rows.join(polys.select(key, *attrs), key, how) if attrs else rows


def roads_with_point(roads: DataFrame, line: str = "line") -> DataFrame:
    """All columns plus the representative point ``px, py`` of each road (ST_PointOnSurface)."""
    p = geom.with_point_on_line(roads, line, "_pt")
    # non-nullable coordinates (NaN for an empty line, which matches no polygon just as null would):
    # otherwise Catalyst infers IS NOT NULL filters from the join predicates and pushes them below
    # these projections, re-evaluating the point expression
    nan = F.lit(float("nan"))
    return p.select(*roads.columns, F.coalesce(F.col("_pt.x"), nan).alias("px"), F.coalesce(F.col("_pt.y"), nan).alias("py"))


def assign_pref(roads: DataFrame, admin: DataFrame, **index) -> DataFrame:
    """Roads (all columns) with ``gid``, ``admin_code`` and ``pref_code = left(admin_code, 2)`` of the
    admin polygon holding their point; unmatched roads drop."""
    hit = points_in_polygons(roads_with_point(roads), admin.select("gid", "admin_code", "mpoly"), **index)
    return hit.select(*roads.columns, "gid", "admin_code", F.left(F.col("admin_code"), F.lit(2)).alias("pref_code"))


def unmatched(roads: DataFrame, admin: DataFrame, key: str = "fid", **index) -> DataFrame:
    """Keys of the roads whose point lies in no polygon (J5): the same joins with misses kept, then
    one aggregate of narrow (key, hit) rows."""
    marked = points_in_polygons(roads_with_point(roads.select(key, "line")).drop("line"), admin.select("gid", "mpoly"),
                                keep_misses=True, **index)
    return marked.groupBy(key).agg(F.count("gid").alias("_n")).where("_n = 0").select(key)
