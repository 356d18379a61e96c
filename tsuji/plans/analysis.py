"""Analytic queries over ``roads``: lengths, counts, rank / share / cumulative windows.

Shape of every analysis: per-row length computed in the scan stage (no shuffle), partial + final hash
aggregate (one shuffle of at most a few hundred groups), broadcast decode join against a fixed code
table, then one window over that small aggregated result. The three window reports share one written
table of partial sums, so segments are measured once for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geodesy, geom
from ..operators.codes import decode
from ..sources import fixtures


def with_length(roads: DataFrame, spheroid: bool = False, out: str = "len_m") -> DataFrame:
    """Attach the geodesic length of ``line`` per row (higher-order-function form; for small sets)."""
    f = geodesy.length_spheroid if spheroid else geodesy.length_sphere
    return roads.withColumn(out, f("line"))


def segment_lengths(roads: DataFrame, keys: tuple[str, ...], spheroid: bool = False) -> DataFrame:
    """Segment rows (``keys``, ``seg_pos``, ``seg_len`` in metres) measured with codegen'd column
    arithmetic inside the scan stage."""
    rows = roads.select(*keys, "line")
    return geodesy.spheroid_segments(rows, keep=keys) if spheroid else geodesy.with_sphere_length(geodesy.segment_rows(rows, keep=keys))


def _n_and_total():
    return [F.count_if(geodesy.is_first_segment()).alias("n"), F.sum("seg_len").alias("total")]


def lengths_by(roads: DataFrame, keys: tuple[str, ...], spheroid: bool = False) -> DataFrame:
    """Per group of ``keys``: number of lines ``n`` and unrounded total length ``total`` in metres.
    The partial aggregate leaves one row per group and task before the only shuffle."""
    return segment_lengths(roads, keys, spheroid).groupBy(*keys).agg(*_n_and_total())


def length_by_type(spark: SparkSession, roads: DataFrame, spheroid: bool = False) -> DataFrame:
    """Total length per road-type label (sphere unless ``spheroid``), longest first.

    Labels are attached on the map side (hash probe into the broadcast 5-row code table), so one
    partial/final aggregate by label is the only shuffle of more than a row per label (the final
    order is a range exchange of those rows)."""
    seg = decode(segment_lengths(roads, ("road_type",), spheroid), spark, "road_type", "road_type_label")
    agg = seg.groupBy("road_type_label").agg(F.sum("seg_len").alias("total"))
    return agg.select(F.col("road_type_label").alias("road_type"),
                      F.round("total", 1).alias("total_length_m")).orderBy(F.desc("total_length_m"))


def count_by_type(roads: DataFrame) -> DataFrame:
    """``SELECT road_type, count(*)`` — reads only the one attribute column."""
    return roads.groupBy("road_type").agg(F.count(F.lit(1)).alias("n")).orderBy("road_type")


def count_all(roads: DataFrame) -> DataFrame:
    """Global ``count(*)``; parquet answers it from footers (no column is read)."""
    return roads.agg(F.count(F.lit(1)).alias("n"))


PARTIAL_KEYS = ("source_mesh", "road_type", "road_classification", "width_category")


def partial_lengths(roads: DataFrame) -> DataFrame:
    """Count and spheroid length per mesh and combination of codes: the one pass over all segments that
    every report below rolls up (sums and counts merge, so any coarser grouping follows)."""
    return lengths_by(roads, PARTIAL_KEYS, spheroid=True)


def _rolled_up(spark: SparkSession, partials: DataFrame, code: str, label: str, *keys: str) -> DataFrame:
    """``n`` and ``total`` per label of ``code`` and ``keys``."""
    return (decode(partials.select(*keys, code, "n", "total"), spark, code, label, keep_code=code in keys)
            .groupBy(*keys, label).agg(F.sum("n").alias("n"), F.sum("total").alias("total")))


def rank_in_mesh(spark: SparkSession, partials: DataFrame) -> DataFrame:
    """Per mesh: count and total spheroid length per road type, ranked by the unrounded total (A4, W1, M1),
    from ``partial_lengths``.

    ``RANK() OVER (PARTITION BY mesh ORDER BY total DESC)`` with SQL's DESC-puts-nulls-first rule.
    """
    agg = _rolled_up(spark, partials, "road_type", "road_type_label", "source_mesh")
    w = Window.partitionBy("source_mesh").orderBy(F.desc_nulls_first("total"))
    return agg.select("source_mesh", "road_type_label", "n", F.round("total", 1).alias("total_len_m"),
                      F.rank().over(w).cast("long").alias("len_rank")).orderBy("source_mesh", "len_rank")


def class_share(spark: SparkSession, partials: DataFrame) -> DataFrame:
    """Count and spheroid length per road class with their share of the totals (W2, M2), from
    ``partial_lengths``.

    ``sum() OVER ()`` runs on the aggregated rows (one per class), so its single partition is tiny.
    """
    agg = _rolled_up(spark, partials, "road_classification", "road_class_label")
    w = Window.partitionBy()
    return agg.select(
        "road_class_label", "n",
        F.round("total", 1).alias("total_len_m"),
        F.round(F.lit(100.0) * F.col("total") / F.sum("total").over(w), 1).alias("len_pct"),
        F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(w), 1).alias("n_pct")).orderBy(F.desc("total_len_m"))


def width_cumulative(spark: SparkSession, partials: DataFrame) -> DataFrame:
    """Per mesh: spheroid length per width class and the running total ordered by width *code* (W3), from
    ``partial_lengths``."""
    agg = _rolled_up(spark, partials, "width_category", "width_label", "source_mesh", "width_category") \
        .withColumnRenamed("width_category", "width_code")
    # default frame with ORDER BY = RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    w = Window.partitionBy("source_mesh").orderBy("width_code")
    return agg.select("source_mesh", "width_code", "width_label", "n", F.round("total", 1).alias("total_len_m"),
                      F.round(F.sum("total").over(w), 1).alias("cum_len_m")).orderBy("source_mesh", "width_code").drop("width_code")


def vertices(roads: DataFrame, key: str = "fid", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per vertex with its successor (J3 lateral expansion, W4 ``lead``, G4 ``ST_PointN``).

    The successor is attached before exploding (``zip_with`` over the vertex array shifted by one),
    which is exactly ``lead(pt) OVER (PARTITION BY line ORDER BY i)`` without shuffling the
    vertex rows by line. ``i`` is 1-based as in ``ST_PointN``.
    """
    ln = F.col("line")
    n = F.size(ln)
    nxt = F.concat(F.slice(ln, 2, F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast(geom.POINT)))
    pairs = F.arrays_zip(ln.alias("pt"), nxt.alias("next_pt"))       # codegen'd, no lambda
    return (roads.select(key, *extra, F.posexplode(pairs).alias("pos", "v"))
            .select(key, *extra, (F.col("pos") + 1).alias("i"), "v.pt", "v.next_pt"))


def lead_by_window(verts: DataFrame, key: str, order: str, col: str, out: str) -> DataFrame:
    """Generic ``lead`` over a window, for vertex rows that arrive unassembled (shuffles by ``key``)."""
    w = Window.partitionBy(key).orderBy(order)
    return verts.withColumn(out, F.lead(col).over(w))


def distance_sphere_latlon(p, q, radius: float = geodesy.SPHERE_DISTANCE_RADIUS_M):
    """Point-to-point sphere distance that reads x as latitude and y as longitude."""
    return geodesy.haversine(p["y"], p["x"], q["y"], q["x"], radius)


def length_by_type_vertices(roads: DataFrame) -> DataFrame:
    """The vertex-row form of the length query (J3, W4, G3, G4, G5):
    flip to (lat, lon) -> one row per vertex -> distance to the successor -> sum per type.
    The last vertex has no successor; its null distance is ignored by ``sum``.
    """
    flipped = roads.select("fid", "road_type", geom.flip("line").alias("line"))
    v = vertices(flipped, extra=("road_type",))
    seg = v.select("fid", "road_type", distance_sphere_latlon(F.col("pt"), F.col("next_pt")).alias("seg_len"))
    return (seg.groupBy("road_type").agg(F.round(F.sum("seg_len"), 1).alias("total_length_m"))
            .orderBy(F.desc("total_length_m")))


def length_spheroid_by_type(spark: SparkSession, roads: DataFrame) -> DataFrame:
    """ST_Length(geography) on the spheroid, summed per road-type label (G1)."""
    return length_by_type(spark, roads, spheroid=True)


def geodesic_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over any distance: one pair of places per customer, up to an ocean apart."""
    pairs = fixtures.far_pairs(spark, sf_dir)
    return geodesy.with_spheroid_length(pairs, "metres").select("fid", F.round("metres", 0).alias("metres"))
