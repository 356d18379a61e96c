"""Geometry as Column expressions (no UDFs).

Lines are ``array<struct<x,y>>``; multipolygons ``array<array<array<struct<x,y>>>>``;
boxes ``struct<xmin,ymin,xmax,ymax>``. Every function returns a Column built from Spark
built-ins and higher-order functions, so Catalyst keeps them in the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
LINE = T.ArrayType(POINT)
RING = LINE
POLYGON = T.ArrayType(RING)
MULTIPOLYGON = T.ArrayType(POLYGON)
BBOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")])


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def point(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


# --------------------------------------------------------------------------- accessors
def num_points(line) -> Column:
    """ST_NumPoints / ST_NPoints."""
    return F.size(_c(line))


def point_n(line, i) -> Column:
    """ST_PointN, 1-based; negative counts from the end as in PostGIS."""
    i = i if isinstance(i, Column) else F.lit(i)
    return F.element_at(_c(line), i)


def segments(line) -> Column:
    """Array of ``struct<a: point, b: point>`` for consecutive vertex pairs (W4 without a shuffle).

    Built from ``slice`` + ``arrays_zip``, which whole-stage codegen compiles (no lambda)."""
    ln = _c(line)
    k = F.greatest(F.size(ln) - 1, F.lit(0))
    return F.arrays_zip(F.slice(ln, 1, k).alias("a"), F.slice(ln, 2, k).alias("b"))


# --------------------------------------------------------------------------- bounds
def bounds(geom) -> Column:
    """Per-row bbox of a line (for a multipolygon pass ``polygon_vertices(...)``).

    ``line.x`` on an array of structs is a plain field extraction (no lambda), so this compiles."""
    g = _c(geom)
    xs, ys = g["x"], g["y"]
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def polygon_vertices(mpoly) -> Column:
    """All vertices of a multipolygon as one point array."""
    return F.flatten(F.flatten(_c(mpoly)))


def envelope(x0: float, y0: float, x1: float, y1: float) -> Column:
    """ST_MakeEnvelope as a literal bbox struct."""
    return F.struct(F.lit(float(x0)).alias("xmin"), F.lit(float(y0)).alias("ymin"),
                    F.lit(float(x1)).alias("xmax"), F.lit(float(y1)).alias("ymax"))


def bbox_covers(bbox, box: tuple[float, float, float, float]) -> Column:
    """Covering predicate (F3): plain comparisons on the nested bbox fields.

    Written as four literal comparisons so the parquet reader receives them as pushed
    filters on ``bbox.xmin`` etc. and can skip row groups by their min/max statistics.
    """
    x0, y0, x1, y1 = (float(v) for v in box)
    b = _c(bbox)
    return (b["xmin"] <= F.lit(x1)) & (b["xmax"] >= F.lit(x0)) & (b["ymin"] <= F.lit(y1)) & (b["ymax"] >= F.lit(y0))


def bbox_overlaps(a, b) -> Column:
    """``a && b`` for two bbox struct columns (closed intervals)."""
    a, b = _c(a), _c(b)
    return (a["xmin"] <= b["xmax"]) & (a["xmax"] >= b["xmin"]) & (a["ymin"] <= b["ymax"]) & (a["ymax"] >= b["ymin"])


# --------------------------------------------------------------------------- exact intersects
def _side(a, b, px, py):
    # sign of the cross product (b - a) x (p - a)
    return (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])


def intersects_box(line, box: tuple[float, float, float, float]) -> Column:
    """Exact ST_Intersects(line, envelope) on the plane, boundary counts.

    A segment meets the closed box iff their bounding boxes overlap and the box's four corners
    are not all strictly on one side of the segment's supporting line (separating-axis test).
    """
    x0, y0, x1, y1 = (F.lit(float(v)) for v in box)

    def seg_hits(a, b):
        overlap = ((F.least(a["x"], b["x"]) <= x1) & (F.greatest(a["x"], b["x"]) >= x0)
                   & (F.least(a["y"], b["y"]) <= y1) & (F.greatest(a["y"], b["y"]) >= y0))
        s = [_side(a, b, cx, cy) for cx, cy in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
        all_pos = (s[0] > 0) & (s[1] > 0) & (s[2] > 0) & (s[3] > 0)
        all_neg = (s[0] < 0) & (s[1] < 0) & (s[2] < 0) & (s[3] < 0)
        return overlap & ~all_pos & ~all_neg

    ln = _c(line)
    n = F.size(ln)
    single = (n == 1) & (ln[0]["x"] >= x0) & (ln[0]["x"] <= x1) & (ln[0]["y"] >= y0) & (ln[0]["y"] <= y1)
    return F.coalesce(single | F.exists(F.zip_with(F.slice(ln, 1, n - 1), F.slice(ln, 2, n - 1), seg_hits),
                                        lambda h: h), F.lit(False))


def intersects_envelope(bbox, line, box: tuple[float, float, float, float]) -> Column:
    """The practical pattern (F4): covering predicate first (prunes row groups), exact test second."""
    return bbox_covers(bbox, box) & intersects_box(line, box)


# --------------------------------------------------------------------------- point in polygon
def _ring_edges(ring):
    n = F.size(ring)
    return F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def contains_point(mpoly, px, py) -> Column:
    """ST_Contains(multipolygon, point): interior only, holes respected, boundary is outside.

    Even-odd ray cast over every ring of a polygon (shell and holes together), and the point is
    rejected when it lies on any edge.
    """
    px, py = _c(px), _c(py)

    def crosses(e):
        a, b = e["a"], e["b"]
        return (((a["y"] > py) != (b["y"] > py))
                & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]))

    def on_edge(e):
        a, b = e["a"], e["b"]
        return ((_side(a, b, px, py) == 0)
                & (px >= F.least(a["x"], b["x"])) & (px <= F.greatest(a["x"], b["x"]))
                & (py >= F.least(a["y"], b["y"])) & (py <= F.greatest(a["y"], b["y"])))

    def in_polygon(poly):
        crossings = F.aggregate(poly, F.lit(0), lambda acc, ring: acc + F.size(F.filter(_ring_edges(ring), crosses)))
        touches = F.exists(poly, lambda ring: F.exists(_ring_edges(ring), on_edge))
        return ((crossings % 2) == 1) & ~touches

    return F.coalesce(F.exists(_c(mpoly), in_polygon), F.lit(False))


# --------------------------------------------------------------------------- point on surface
def point_on_line(line) -> Column:
    """ST_PointOnSurface for a line (interior-point rule for lines).

    Centroid = length-weighted mean of segment midpoints (zero-length segments skipped); the
    interior vertex nearest to it wins, first one on ties; a line without interior vertices
    takes the nearer endpoint, the first on ties. Same arithmetic order as the usual geometry
    libraries so ties fall the same way.
    """
    ln = _c(line)
    n = F.size(ln)
    zero = F.lit(0.0)
    acc0 = F.struct(zero.alias("len"), zero.alias("sx"), zero.alias("sy"))

    def add_seg(acc, s):
        dx = s["b"]["x"] - s["a"]["x"]
        dy = s["b"]["y"] - s["a"]["y"]
        seg = F.sqrt(dx * dx + dy * dy)
        mx = (s["a"]["x"] + s["b"]["x"]) / 2
        my = (s["a"]["y"] + s["b"]["y"]) / 2
        keep = seg != 0
        return F.struct(F.when(keep, acc["len"] + seg).otherwise(acc["len"]).alias("len"),
                        F.when(keep, acc["sx"] + seg * mx).otherwise(acc["sx"]).alias("sx"),
                        F.when(keep, acc["sy"] + seg * my).otherwise(acc["sy"]).alias("sy"))

    tot = F.aggregate(segments(ln), acc0, add_seg)
    # zero total length: centroid of the (coincident) points is the first vertex
    centroid = F.struct(F.when(tot["len"] > 0, tot["sx"] / tot["len"]).otherwise(ln[0]["x"]).alias("cx"),
                        F.when(tot["len"] > 0, tot["sy"] / tot["len"]).otherwise(ln[0]["y"]).alias("cy"))

    def nearest(cands):
        # state: centroid (computed once, in the initial value), best distance, best point
        start = F.struct(centroid.alias("c"), F.lit(None).cast("double").alias("d"), F.lit(None).cast(POINT).alias("p"))

        def visit(acc, p):
            dx = p["x"] - acc["c"]["cx"]
            dy = p["y"] - acc["c"]["cy"]
            d = F.sqrt(dx * dx + dy * dy)
            better = acc["d"].isNull() | (d < acc["d"])
            return F.struct(acc["c"].alias("c"), F.when(better, d).otherwise(acc["d"]).alias("d"),
                            F.when(better, p).otherwise(acc["p"]).alias("p"))

        return F.aggregate(cands, start, visit, lambda acc: acc["p"])

    interior = F.slice(ln, 2, F.greatest(n - 2, F.lit(0)))
    ends = F.array(ln[0], F.element_at(ln, -1))
    return F.when(n == 0, F.lit(None).cast(POINT)).otherwise(nearest(F.when(n > 2, interior).otherwise(ends)))


def line_centroid(line) -> Column:
    """Length-weighted centroid ``struct<x, y>`` of a line (first vertex when the length is 0)."""
    ln = _c(line)
    zero = F.lit(0.0)

    def add_seg(acc, s):
        dx = s["b"]["x"] - s["a"]["x"]
        dy = s["b"]["y"] - s["a"]["y"]
        seg = F.sqrt(dx * dx + dy * dy)
        keep = seg != 0
        return F.struct(F.when(keep, acc["len"] + seg).otherwise(acc["len"]).alias("len"),
                        F.when(keep, acc["sx"] + seg * ((s["a"]["x"] + s["b"]["x"]) / 2)).otherwise(acc["sx"]).alias("sx"),
                        F.when(keep, acc["sy"] + seg * ((s["a"]["y"] + s["b"]["y"]) / 2)).otherwise(acc["sy"]).alias("sy"))

    return F.aggregate(segments(ln), F.struct(zero.alias("len"), zero.alias("sx"), zero.alias("sy")), add_seg,
                       lambda t: F.struct(F.when(t["len"] > 0, t["sx"] / t["len"]).otherwise(ln[0]["x"]).alias("x"),
                                          F.when(t["len"] > 0, t["sy"] / t["len"]).otherwise(ln[0]["y"]).alias("y")))


def nearest_vertex(line, centroid) -> Column:
    """Interior vertex nearest to ``centroid`` (first on ties), else the nearer endpoint.
    ``centroid`` should be a column reference (it is read once per vertex)."""
    ln, c = _c(line), _c(centroid)
    n = F.size(ln)
    cands = F.when(n > 2, F.slice(ln, 2, F.greatest(n - 2, F.lit(1)))).otherwise(F.array(ln[0], F.element_at(ln, -1)))
    d = F.transform(cands, lambda p: F.sqrt((p["x"] - c["x"]) * (p["x"] - c["x"]) + (p["y"] - c["y"]) * (p["y"] - c["y"])))
    return F.when(n == 0, F.lit(None).cast(POINT)).otherwise(F.element_at(cands, F.array_position(d, F.array_min(d)).cast("int")))


def _two_point_choice(line) -> Column:
    """Point on surface of a 2-vertex line in closed form, with the same arithmetic as the general
    path (centroid of the single segment, nearer endpoint, the first on a tie)."""
    ln = _c(line)
    a, b = ln[0], ln[1]
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    seg = F.sqrt(dx * dx + dy * dy)
    cx = F.when(seg != 0, (F.lit(0.0) + seg * ((a["x"] + b["x"]) / 2)) / (F.lit(0.0) + seg)).otherwise(a["x"])
    cy = F.when(seg != 0, (F.lit(0.0) + seg * ((a["y"] + b["y"]) / 2)) / (F.lit(0.0) + seg)).otherwise(a["y"])

    def dist(p):
        return F.sqrt((p["x"] - cx) * (p["x"] - cx) + (p["y"] - cy) * (p["y"] - cy))

    return F.when(dist(b) < dist(a), b).otherwise(a)


# lines with up to this many vertices take the unrolled (lambda-free, compiled) point-on-surface path
POINT_ON_LINE_UNROLL = 8


def _unrolled_centroid(ln, k: int) -> Column:
    """Centroid of a line with 4..k vertices as a left-to-right sum over at most k-1 segments.

    Adding 0.0 for a missing or zero-length segment is an exact identity, so the result equals the
    sequential aggregate bit for bit."""
    n = F.size(ln)
    zero = F.lit(0.0)
    tl, tx, ty = zero, zero, zero
    for i in range(1, k):
        a, b = ln[i - 1], ln[i]
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        seg = F.sqrt(dx * dx + dy * dy)
        ok = n > i                       # segment i joins vertices i-1 and i
        tl = tl + F.when(ok, seg).otherwise(zero)
        tx = tx + F.when(ok, seg * ((a["x"] + b["x"]) / 2)).otherwise(zero)
        ty = ty + F.when(ok, seg * ((a["y"] + b["y"]) / 2)).otherwise(zero)
    return F.struct(F.when(tl > 0, tx / tl).otherwise(ln[0]["x"]).alias("x"),
                    F.when(tl > 0, ty / tl).otherwise(ln[0]["y"]).alias("y"))


def _unrolled_nearest_interior(ln, c, k: int) -> Column:
    """Interior vertex nearest to centroid ``c`` for a line of 4..k vertices, the first on ties."""
    n = F.size(ln)
    d = [F.when(n - 1 > j, F.sqrt((ln[j]["x"] - c["x"]) * (ln[j]["x"] - c["x"])
                                  + (ln[j]["y"] - c["y"]) * (ln[j]["y"] - c["y"])))
         for j in range(1, k - 1)]       # interior vertices 1..n-2; missing ones are null (ignored)
    arr = F.array(*d)
    return F.element_at(ln, (F.array_position(arr, F.array_min(arr)) + 1).cast("int"))


def with_point_on_line(df, line: str = "line", out: str = "pt"):
    """DataFrame form of ``point_on_line``: centroid and vertex choice as separate projections so
    neither is evaluated more than once per row.

    Lines of up to ``POINT_ON_LINE_UNROLL`` vertices need no lambda: 1 vertex is itself, 2 are
    decided in closed form, 3 have exactly one interior vertex, 4..8 use an unrolled sum and a
    first-minimum search over at most 6 candidates. Only longer lines run the general aggregate."""
    k = POINT_ON_LINE_UNROLL
    cols = [c for c in df.columns]
    ln = F.col(line)
    n = F.size(ln)
    cen = F.when(n < 4, F.lit(None).cast(POINT)).when(n <= k, _unrolled_centroid(ln, k)).otherwise(line_centroid(line))
    step = df.select(*cols, cen.alias("_centroid"))
    c = F.col("_centroid")
    pt = (F.when(ln.isNull() | (n == 0), F.lit(None).cast(POINT))
          .when(n == 1, ln[0])
          .when(n == 2, _two_point_choice(ln))
          .when(n == 3, ln[1])
          .when(n <= k, _unrolled_nearest_interior(ln, c, k))
          .otherwise(nearest_vertex(line, "_centroid")))
    return step.select(*cols, pt.alias(out))


# --------------------------------------------------------------------------- coordinate ops
def flip(line) -> Column:
    """ST_FlipCoordinates (x and y swapped; ``arrays_zip`` of the two field arrays, no lambda)."""
    ln = _c(line)
    return F.when(ln.isNotNull(), F.arrays_zip(ln["y"].alias("x"), ln["x"].alias("y")))


# The only coordinate systems the data uses: JGD2011 geographic and WGS 84 (fixed values).
NULL_TRANSFORM_SRIDS = (6668, 4326)


def transform_crs(geom, src_srid: int, dst_srid: int) -> Column:
    """ST_Transform between the two geographic systems that coincide at this precision.

    Only the null transform 6668 <-> 4326 is supported; anything else is an error (no
    projection engine here).
    """
    if src_srid == dst_srid or {src_srid, dst_srid} <= set(NULL_TRANSFORM_SRIDS):
        return _c(geom)
    raise ValueError(f"unsupported transform EPSG:{src_srid} -> EPSG:{dst_srid}")


def with_srid(df, col: str, srid: int):
    """Tag a geometry column with its SRID in the column metadata."""
    meta = dict(df.schema[col].metadata or {})
    meta["srid"] = int(srid)
    return df.withMetadata(col, meta)


def srid_of(df, col: str) -> int | None:
    """crs_epsg / Find_SRID: the SRID tag of a geometry column, or None."""
    v = (df.schema[col].metadata or {}).get("srid")
    return int(v) if v is not None else None


# --------------------------------------------------------------------------- WKT
def line_from_wkt(wkt) -> Column:
    """ST_GeomFromText for ``LINESTRING(x y, x y, ...)``; other types give null."""
    body = F.regexp_extract(_c(wkt), r"(?i)^\s*LINESTRING\s*\(\s*(.*?)\s*\)\s*$", 1)
    pts = F.split(body, r"\s*,\s*")
    return F.when(body == "", F.lit(None).cast(LINE)).otherwise(
        F.transform(pts, lambda s: F.struct(
            F.split(F.trim(s), r"\s+")[0].cast("double").alias("x"),
            F.split(F.trim(s), r"\s+")[1].cast("double").alias("y"))))


def line_to_wkt(line) -> Column:
    """ST_AsText for a line (shortest round-trip decimal form of each coordinate)."""
    return F.concat(F.lit("LINESTRING("),
                    F.array_join(F.transform(_c(line), lambda p: F.concat_ws(" ", p["x"].cast("string"),
                                                                              p["y"].cast("string"))), ", "),
                    F.lit(")"))


# --------------------------------------------------------------------------- validity
def is_empty(geom) -> Column:
    return F.size(_c(geom)) == 0


def line_is_valid(line) -> Column:
    """A line is valid with >= 2 distinct vertices, all finite (self-crossing allowed for lines).

    ``array_max`` orders NaN above everything, so max/min over the coordinate arrays detect NaN and
    infinities without a lambda."""
    ln = _c(line)
    inf = float("inf")

    def finite(v):
        return ~F.isnan(F.array_max(v)) & (F.array_max(v) < inf) & (F.array_min(v) > -inf)

    return (F.size(F.array_distinct(ln)) >= 2) & finite(ln["x"]) & finite(ln["y"])


def polygon_is_valid(mpoly) -> Column:
    """No rule of ``validity`` is broken: rings closed and simple, holes in their shell and not in each
    other, polygons apart, interiors connected."""
    from .validity import polygon_fault

    return polygon_fault(_c(mpoly)).isNull()


def line_status(line) -> Column:
    """'missing' | 'empty' | 'invalid' | 'ok' for a line column."""
    ln = _c(line)
    return (F.when(ln.isNull(), "missing").when(F.size(ln) == 0, "empty")
            .when(~line_is_valid(ln), "invalid").otherwise("ok"))


def polygon_status(mpoly) -> Column:
    g = _c(mpoly)
    return (F.when(g.isNull(), "missing").when(F.size(g) == 0, "empty")
            .when(~polygon_is_valid(g), "invalid").otherwise("ok"))


# --------------------------------------------------------------------------- multipolygon
def to_multipolygon(geom_type, polygon_rings, multi_rings) -> Column:
    """Polygon -> 1-element multipolygon, MultiPolygon kept, null/empty -> null, other types -> error."""
    t = _c(geom_type)
    p = _c(polygon_rings)
    m = _c(multi_rings)
    return (F.when(t.isNull(), F.lit(None).cast(MULTIPOLYGON))
            .when((t == "Polygon") & (F.coalesce(F.size(p), F.lit(0)) > 0), F.array(p))
            .when(t == "Polygon", F.lit(None).cast(MULTIPOLYGON))
            .when((t == "MultiPolygon") & (F.coalesce(F.size(m), F.lit(0)) > 0), m)
            .when(t == "MultiPolygon", F.lit(None).cast(MULTIPOLYGON))
            .otherwise(F.raise_error(F.concat(F.lit("unexpected geometry type: "), t)).cast(MULTIPOLYGON)))


# --------------------------------------------------------------------------- Hilbert code
HILBERT_ORDER = 16
HILBERT_MAX = (1 << HILBERT_ORDER) - 1  # 65535
# steps fused into one projection (repeated subexpressions are shared by Catalyst); keeps the
# generated method of the stage under the JVM's JIT size limit
HILBERT_STEPS_PER_PROJECTION = 1


def _hilbert_scale(v, lo, hi):
    ext = hi - lo
    return F.when(ext == 0, F.lit(0)).otherwise(
        F.least(F.lit(HILBERT_MAX), F.floor((v - lo) * HILBERT_MAX / ext).cast("int"))).cast("long")


def hilbert_distance(bbox, total) -> Column:
    """Hilbert index of the bbox centre on a 2^16 x 2^16 grid spanning the total bounds.

    ``total`` is a bbox struct column (usually the global bounds joined as one row).
    """
    b, t = _c(bbox), _c(total)
    mx = (b["xmin"] + b["xmax"]) / 2
    my = (b["ymin"] + b["ymax"]) / 2
    hx = _hilbert_scale(mx, t["xmin"], t["xmax"])
    hy = _hilbert_scale(my, t["ymin"], t["ymax"])
    start = F.struct(hx.alias("x"), hy.alias("y"), F.lit(0).cast("long").alias("d"))

    def step(a, i):
        bit = F.pow(F.lit(2), i).cast("long")          # 2^i
        rx = F.when(a["x"].bitwiseAND(bit) > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
        ry = F.when(a["y"].bitwiseAND(bit) > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
        flip_ = ry == 0
        nx = F.when(flip_, F.when(rx == 1, HILBERT_MAX - a["y"]).otherwise(a["y"])).otherwise(a["x"])
        ny = F.when(flip_, F.when(rx == 1, HILBERT_MAX - a["x"]).otherwise(a["x"])).otherwise(a["y"])
        q = (F.lit(3).cast("long") * rx).bitwiseXOR(ry)
        return F.struct(nx.alias("x"), ny.alias("y"), (a["d"] + q * bit * bit).alias("d"))

    out = F.aggregate(F.sequence(F.lit(HILBERT_ORDER - 1), F.lit(0), F.lit(-1)), start, step)["d"]
    return F.when(b.isNull(), F.raise_error(F.lit("hilbert_distance: null geometry")).cast("long")).otherwise(out)


def with_hilbert(df, bbox, total: tuple[float, float, float, float], out: str = "hilbert"):
    """DataFrame form of ``hilbert_distance`` against literal total bounds: the 16 steps unrolled as
    projections with literal shifts (compiled by whole-stage codegen instead of an interpreted
    ``aggregate``). Same result as the Column form. A null bbox stays null through the steps and
    raises at the end."""
    x0, y0, x1, y1 = (float(v) for v in total)
    b = _c(bbox)
    keep = list(df.columns)

    def scale(v, lo, hi):
        if hi - lo == 0:
            return F.when(v.isNotNull(), F.lit(0).cast("long"))
        return F.least(F.lit(HILBERT_MAX), F.floor((v - F.lit(lo)) * HILBERT_MAX / F.lit(hi - lo)).cast("int")).cast("long")

    d = df.select(*keep, scale((b["xmin"] + b["xmax"]) / 2, x0, x1).alias("_hx"),
                  scale((b["ymin"] + b["ymax"]) / 2, y0, y1).alias("_hy"), F.lit(0).cast("long").alias("_hd"))
    steps = list(range(HILBERT_ORDER - 1, -1, -1))
    for k in range(0, len(steps), HILBERT_STEPS_PER_PROJECTION):
        x, y, acc = F.col("_hx"), F.col("_hy"), F.col("_hd")
        for i in steps[k:k + HILBERT_STEPS_PER_PROJECTION]:
            rx = F.shiftright(x, i).bitwiseAND(1)
            ry = F.shiftright(y, i).bitwiseAND(1)
            # quadrant rotation: swap when ry = 0, and reflect (65535 - v = v xor 65535) when rx = 1
            t = rx * HILBERT_MAX
            nx = F.when(ry == 0, y.bitwiseXOR(t)).otherwise(x)
            ny = F.when(ry == 0, x.bitwiseXOR(t)).otherwise(y)
            acc = acc + F.shiftleft((rx * 3).bitwiseXOR(ry), 2 * i)
            x, y = nx, ny
        d = d.select(*keep, x.alias("_hx"), y.alias("_hy"), acc.alias("_hd"))
    return d.select(*keep, F.when(F.col("_hd").isNotNull(), F.col("_hd")).otherwise(
        F.raise_error(F.lit("hilbert_distance: null geometry")).cast("long")).alias(out))
