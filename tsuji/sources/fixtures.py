"""Road, admin-area and HTTP-log tables derived from the driver's parquet tables.

The source road data (national road centre-lines) needs the network, so the same shapes are
derived from ``orders`` / ``nation`` / ``region`` / ``events``: one road per order, one admin
polygon per nation, one HTTP log line per event. Coordinates come from integer arithmetic
divided once by 1e6, so any engine computing the same expression holds bit-equal doubles.
Everything is a narrow projection of a scan: it grows with the tables and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geom import with_srid
from ..session import dealt_out, materialized


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The four first-order mesh codes used by the fixture.
MESHES = ("3622", "3631", "3724", "5339")

_ROAD_ATTRS = [
    "fid",
    "cast(1 + fid % 5 AS smallint) AS road_type",
    "cast(1 + ck % 6 AS smallint) AS road_classification",
    "cast(1 + (fid div 7) % 7 AS smallint) AS road_status",
    "cast(1 + (fid div 3) % 6 AS smallint) AS width_category",
    "cast(1 + ck % 2 AS smallint) AS toll_category",
    "cast(od AS date) AS registration_date",
    "cast(fid % 3 - 1 AS smallint) AS layer_order",
    "mesh AS source_mesh",
    "concat(mesh, lpad(cast(fid % 100 AS string), 2, '0')) AS secondary_mesh_code",
]

# x = 139 + ((k*7919) mod 1e6 + i*20*(100 + k mod 700)) / 1e6, y likewise with i^2; 2..5 vertices.
_LINE = """
  transform(sequence(0, cast(1 + k % 4 AS int)), i -> struct(
    (139000000 + (k * 7919) % 1000000 + i * 20 * (100 + k % 700)) / 1e6D AS x,
    (35000000 + (k * 6007) % 1000000 + i * i * 20 * (50 + k % 300)) / 1e6D AS y)) AS line
"""


def _orders_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    mesh_arr = ", ".join(f"'{m}'" for m in MESHES)
    # Every 50th order copies the previous order's geometry: gives cross-mesh and same-mesh duplicates.
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS fid", "o_custkey AS ck", "o_orderdate AS od",
        "o_orderkey - CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS k",
        f"element_at(array({mesh_arr}), cast(1 + o_custkey % 4 AS int)) AS mesh")


def derive_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fact table ``roads`` (EPSG:4326) computed from ``orders``: attributes + ``line``."""
    df = _orders_keyed(spark, sf_dir).selectExpr(*_ROAD_ATTRS, _LINE)
    return with_srid(df, "line", 4326)


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``roads`` as the queries read it: the derived table written once per application as parquet
    (the pipeline's merged output), so scans are vectorised and prune columns and row groups."""
    path = materialized(spark, "roads", (sf_dir,), lambda: derive_roads(spark, sf_dir).repartition("fid"))
    return spark.read.parquet(path)


def long_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fid, line`` with 9 to 16 vertices per line, by the same coordinate rule."""
    line = _LINE.replace("cast(1 + k % 4 AS int)", "cast(8 + k % 8 AS int)")
    return _orders_keyed(spark, sf_dir).selectExpr("fid", line)


def flawed_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fid, source_mesh, line`` in which some lines are missing, empty, a single point, hold an
    infinite coordinate, or run through zeros of either sign (two meshes sharing each sign)."""
    point = lambda x, y: F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))
    k, line = F.col("fid") % 23, F.col("line")
    zero = F.when(F.col("fid").bitwiseAND(1) == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    return roads(spark, sf_dir).select("fid", "source_mesh", (
        F.when(k == 1, F.lit(None)).when(k == 2, F.slice(line, 1, 0)).when(k == 3, F.array(line[0], line[0]))
        .when(k == 4, F.array(line[0], point("inf", 35.0)))
        .when(k == 5, F.array(F.struct(zero.alias("x"), F.lit(1.0).alias("y")), point(1.0, 2.0))).otherwise(line)).alias("line"))


def flawed_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage table with unknown codes, missing values and repeated keys in some rows."""
    fid = F.col("fid")
    return (roads_stage(spark, sf_dir)
            .withColumn("road_type", F.when(fid % 31 == 1, F.lit("9")).otherwise(F.col("road_type")))
            .withColumn("toll_category", F.when(fid % 37 == 2, F.lit(None)).otherwise(F.col("toll_category")))
            .withColumn("registration_date", F.when(fid % 41 == 3, F.lit(None)).otherwise(F.col("registration_date")))
            .withColumn("geometry", F.when(fid % 43 == 4, F.lit(None)).otherwise(F.col("geometry")))
            .withColumn("fid", F.when(fid % 47 == 5, fid - fid % 2).otherwise(fid)))


def admin_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fid, mpoly``: a polygon per order around its first vertex - a square, a bow-tie, an open ring,
    an empty or a missing one."""
    x, y = F.col("line")[0]["x"], F.col("line")[0]["y"]
    pt = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    ring = lambda *c: F.array(F.array(F.array(*[pt(a, b) for a, b in c])))
    k = F.col("fid") % 5
    none = F.lit(None).cast("array<array<array<struct<x:double,y:double>>>>")
    return derive_roads(spark, sf_dir).select("fid", (
        F.when(k == 0, ring((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))).when(k == 1, ring((0, 0), (1, 0), (1, 1), (0, 1)))
        .when(k == 2, none).when(k == 3, F.slice(ring((0, 0), (1, 0), (1, 1), (0, 0)), 1, 0))
        .otherwise(ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)))).alias("mpoly"))


def _square(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


_BIG = _square(0, 0, 12, 12)
# Multipolygons (polygons of rings of vertices) on a 12 x 12 grid: valid ones, and one rule broken each.
SHAPES = [
    [[_BIG]],
    [[_BIG, _square(2, 2, 4, 4), _square(6, 6, 9, 9)]],
    [[_BIG, _square(2, 2, 4, 4), _square(4, 4, 6, 6)]],                          # holes touch in a point
    [[_BIG, [(0, 6), (3, 5), (3, 7), (0, 6)]]],                                  # a hole touches the shell
    [[_BIG, _square(1, 1, 11, 11)], [_square(3, 3, 5, 5)]],                      # an island in a hole
    [[_square(0, 0, 4, 4)], [_square(4, 4, 8, 8)]],                              # polygons touch in a point
    [[_BIG, _square(14, 2, 16, 4)]],                                             # a hole outside
    [[_BIG, _square(1, 1, 9, 9), _square(3, 3, 5, 5)]],                          # a hole in a hole
    [[_BIG, [(0, 6), (6, 3), (12, 6), (6, 9), (0, 6)]]],                         # a hole parts the interior
    [[_BIG, _square(2, 2, 4, 4), _square(4, 4, 6, 6), [(4, 2), (7, 2), (6, 4), (5, 3), (4, 2)]]],   # holes in a ring
    [[_BIG, _square(0, 4, 3, 8)]],                                               # a hole along an edge
    [[_BIG, _square(10, 2, 16, 5)]],                                             # a hole through the shell
    [[_square(0, 0, 6, 6)], [_square(4, 4, 10, 10)]],                            # polygons overlap
    [[_BIG], [_square(3, 3, 5, 5)]],                                             # a polygon in a polygon
    [[[(0, 0), (6, 6), (12, 0), (12, 12), (6, 6), (0, 12), (0, 0)]]],            # a ring touches itself
    [[[(0, 0), (12, 12), (12, 0), (0, 12), (0, 0)]]],                            # a bow-tie
    [[[(0, 0), (12, 0), (12, 6), (12, 12), (0, 12), (0, 0)], [(8, 4), (12, 6), (16, 4), (16, 8), (8, 8), (8, 4)]]],
    [[[(0, 0), (8, 0), (8, 8), (8, 12), (8, 8), (0, 8), (0, 0)]]],               # a spike
    [[_BIG[:4]]],                                                                # an open ring
    [[[(0, 0), (5, 5), (0, 0), (5, 5), (0, 0)]]],                                # a ring of two points
]


def shaped_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fid, mpoly``: one of SHAPES per customer, moved and scaled by powers of two (exact coordinates). The
    keys are dealt out before they become polygons."""
    rows = [(k, [[[(float(x), float(y)) for x, y in ring] for ring in p] for p in s]) for k, s in enumerate(SHAPES)]
    shapes = spark.createDataFrame(rows, "kind int, shape array<array<array<struct<x: double, y: double>>>>")
    placed = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS fid", f"cast(c_custkey % {len(SHAPES)} AS int) AS kind", "c_custkey % 300 - 150 AS x0",
        "c_custkey div 7 % 120 - 60 AS y0", "element_at(array(0.125D, 0.25D, 1D, 2D), cast(1 + c_custkey div 20 % 4 AS int)) AS s")
    return dealt_out(placed).join(F.broadcast(shapes), "kind").selectExpr(
        "fid", "transform(shape, p -> transform(p, r -> transform(r, v -> struct(x0 + v.x * s AS x, y0 + v.y * s AS y)))) AS mpoly")


def far_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fid, lon1, lat1, lon2, lat2``: two places per customer, at most 100 degrees of longitude and 120 of
    latitude apart, some of them on the equator or on one meridian."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS fid", "(c_custkey * 7919 % 3600) / 10D - 180 AS lon1", "(c_custkey * 6007 % 1201) / 10D - 60 AS lat1",
        "(c_custkey * 7919 % 3600) / 10D - 180 + CASE c_custkey % 10 WHEN 3 THEN 0 ELSE (c_custkey * 104729 % 1000) / 10D END AS lon2",
        "CASE c_custkey % 10 WHEN 7 THEN (c_custkey * 6007 % 1201) / 10D - 60 ELSE (c_custkey * 3571 % 1201) / 10D - 60 END AS lat2")


def roads_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loosely typed stage table (codes as text, timestamp date, int layer), EPSG:6668."""
    df = _orders_keyed(spark, sf_dir).selectExpr(
        "fid",
        "cast(1 + fid % 5 AS string) AS road_type",
        "cast(1 + ck % 6 AS string) AS road_classification",
        "cast(1 + (fid div 7) % 7 AS string) AS road_status",
        "cast(1 + (fid div 3) % 6 AS string) AS width_category",
        "cast(1 + ck % 2 AS string) AS toll_category",
        "od AS registration_date",
        "cast(fid % 3 - 1 AS int) AS layer_order",
        "mesh AS source_mesh",
        "concat(mesh, lpad(cast(fid % 100 AS string), 2, '0')) AS secondary_mesh_code",
        _LINE.replace("AS line", "AS geometry"))
    return with_srid(df, "geometry", 6668)


def raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw mesh features as delivered: ``N13_001..N13_008`` text attributes, the archive file
    name they came from, and the line (EPSG:6668)."""
    df = _orders_keyed(spark, sf_dir).selectExpr(
        "fid",
        "date_format(od, 'yyyy-MM-dd') AS N13_001",
        "cast(1 + fid % 5 AS string) AS N13_002",
        "cast(1 + ck % 6 AS string) AS N13_003",
        "cast(1 + (fid div 7) % 7 AS string) AS N13_004",
        "cast(fid % 3 - 1 AS string) AS N13_005",
        "cast(1 + (fid div 3) % 6 AS string) AS N13_006",
        "cast(1 + ck % 2 AS string) AS N13_007",
        "concat(mesh, lpad(cast(fid % 100 AS string), 2, '0')) AS N13_008",
        "concat('N13-24_', mesh, '_GEOJSON.zip') AS file_name",
        _LINE.replace("AS line", "AS geometry"))
    return with_srid(df, "geometry", 6668)


# Admin cells: 0.2 degree squares on a 5-wide grid from (139, 35); every sixth has a hole.
ADMIN_CELL = 0.2
HOLE_LO, HOLE_HI = 0.075, 0.125


def admin_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admin polygons as read from the source: attribute names of the delivery, geometry type
    and ring coordinates (EPSG:6668). Holes and the grid's outside leave some roads unmatched."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    df = (nation.join(region, nation.n_regionkey == region.r_regionkey)
          .selectExpr(
              "n_nationkey AS src_id",
              "concat(cast(10 + n_regionkey AS string), lpad(cast(n_nationkey AS string), 3, '0')) AS N03_007",
              "r_name AS N03_001",
              "n_name AS N03_004",
              "139 + (n_nationkey % 5) * 0.2D AS x0", "35 + (n_nationkey div 5) * 0.2D AS y0",
              "n_nationkey % 6 = 0 AS has_hole"))
    shell = ("array(struct(x0 AS x, y0 AS y), struct(x0 + 0.2D AS x, y0 AS y), struct(x0 + 0.2D AS x, y0 + 0.2D AS y),"
             " struct(x0 AS x, y0 + 0.2D AS y), struct(x0 AS x, y0 AS y))")
    hole = ("array(struct(x0 + 0.075D AS x, y0 + 0.075D AS y), struct(x0 + 0.125D AS x, y0 + 0.075D AS y),"
            " struct(x0 + 0.125D AS x, y0 + 0.125D AS y), struct(x0 + 0.075D AS x, y0 + 0.125D AS y),"
            " struct(x0 + 0.075D AS x, y0 + 0.075D AS y))")
    out = df.selectExpr(
        "src_id", "N03_007", "N03_001", "N03_004",
        "'Polygon' AS geom_type",
        f"CASE WHEN has_hole THEN array({shell}, {hole}) ELSE array({shell}) END AS rings",
        "CAST(NULL AS array<array<array<struct<x:double,y:double>>>>) AS multi_rings")
    return with_srid(out, "rings", 6668)


def http_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTTP log message per event, grouped into probes by ``user_id``, ordered by ``event_id``.

    Every tenth event is a HEAD for the whole file; the rest are ranged GETs.
    """
    ev = table(spark, sf_dir, "events")
    head = F.col("event_id") % 10 == 0
    eid = F.col("event_id").cast("string")
    last = (F.col("event_id") + 999).cast("string")
    msg = F.concat(
        F.lit("{'request': {'type': "), F.when(head, "HEAD").otherwise("GET"),
        F.lit(", 'headers': {User-Agent='x/1'"),
        F.when(head, "").otherwise(F.concat(F.lit(", Range='bytes="), eid, F.lit("-"), last, F.lit("'"))),
        F.lit("}}, 'response': {'status': "), F.when(head, "OK_200").otherwise("PartialContent_206"),
        F.lit(", 'headers': {Content-Length='"),
        F.when(head, "47673370").otherwise((1000 + (F.col("event_id") * 7919) % 60000).cast("string")), F.lit("'"),
        F.when(head, "").otherwise(F.concat(F.lit(", Content-Range='bytes "), eid, F.lit("-"), last,
                                            F.lit("/47673370'"))),
        F.lit("}}}"))
    return ev.select(F.col("event_id").alias("seq"), F.col("user_id").alias("probe"), msg.alias("message"))
