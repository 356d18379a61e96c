"""Ingest queries: archives -> features, WKB interchange, incremental (streaming) ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geom, text, wkb
from ..operators import warehouse as wh
from ..session import scratch_path
from ..sinks import geoparquet, parts
from ..sources import fixtures as fx
from ..sources import geojson, mesh_archive


# Names of one and the same CRS that deliveries use (fixed values).
CRS_NAMES = ("urn:ogc:def:crs:EPSG::6668", "urn:ogc:def:crs:EPSG:6.9:6668", "EPSG:6668", "http://www.opengis.net/def/crs/EPSG/0/6668")


def write_archives(spark: SparkSession, sf_dir: str, root: str, features_per_archive: int = 500,
                   with_id: bool = True, bad_rows: bool = False) -> int:
    """Deliver the raw features as zipped GeoJSON archives (several per mesh, in every layout and CRS
    spelling, with an attribute the delivery does not know); returns the archive count."""
    raw = fx.raw_features(spark, sf_dir)
    src = raw.select(text.mesh_code_from_name("file_name").alias("mesh"), "fid",
                     F.concat(F.lit("survey \"é\" "), F.col("fid") % 7).alias("note"),
                     *[c for c in raw.columns if c.startswith("N13_")], "geometry")
    return geojson.write_mesh_archives(src, root, features_per_archive=features_per_archive, keep_key=with_id,
                                       crs_names=CRS_NAMES, layouts=geojson.LAYOUTS).count()


def geojson_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all layouts read back, every attribute and vertex count per feature."""
    root = scratch_path(spark, "archives")
    write_archives(spark, sf_dir, root)
    norm = wh.normalize_roads(geojson.read_mesh_archives(spark, root), file_col="file_name")
    return norm.select(F.col("fid").cast("long").alias("fid"), "note", *wh.COLUMN_MAP.values(), "source_mesh", "geom_type",
                       F.size("geometry").alias("npts"), F.element_at("geometry", -1)["x"].alias("xn"),
                       F.element_at("geometry", -1)["y"].alias("yn"), "srid",
                       F.lit(geom.srid_of(norm, "geometry")).alias("tagged_srid"))


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 / S8 by the data source: features of the archives whose mesh cell meets a box, the others unopened."""
    root = scratch_path(spark, "archives")
    write_archives(spark, sf_dir, root)
    texts = mesh_archive.scan_archives(spark, root, box=(131.0, 24.5, 138.5, 36.5))
    rows = mesh_archive.features_of(texts, ["fid", *wh.COLUMN_MAP])
    return wh.normalize_roads(rows, file_col="file_name").select(
        F.col("fid").cast("long").alias("fid"), *wh.COLUMN_MAP.values(), "source_mesh", F.size("geometry").alias("npts"),
        F.element_at("geometry", -1)["x"].alias("xn"), "srid")


def wkb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line written as WKB and read back into the native form equals the original."""
    r = fx.roads(spark, sf_dir).select("fid", "line")
    path = parts.write_wkb(r.withColumn("geometry", F.col("line")), scratch_path(spark, "wkb"))
    size = spark.read.parquet(path).select("fid", F.length("geometry").alias("nbytes"))
    back = parts.read_geoparquet(spark, path).select("fid", (F.col("geometry") == F.col("line")).alias("same"))
    return size.join(back, "fid")


def geoparquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roads written as GeoParquet; per mesh the lines that come back equal, and CRS and union box
    as the files' footers tell them."""
    r = fx.roads(spark, sf_dir).select("fid", "source_mesh", "line")
    path = geoparquet.write_geoparquet(r.withColumn("original", F.col("line")), scratch_path(spark, "geoparquet"), line="line", srid=6668)
    back = parts.read_geoparquet(spark, path).groupBy("source_mesh").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("geometry") == F.col("original")).alias("same"),
        F.count_if(geom.bounds("geometry") == F.col("bbox")).alias("covered"))
    footer = geoparquet.dataset_geo(spark, path).first()              # one row: a dataset written at once
    return back.select("*", *[F.lit(footer[c]).alias(c) for c in ("srid", *geoparquet.BOX)])


def polygon_geoparquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12 / K3 on multipolygons: vertices that come back equal, and the rule broken after the round trip."""
    shapes = fx.shaped_polygons(spark, sf_dir)
    path = geoparquet.write_geoparquet(shapes.withColumn("original", F.col("mpoly")), scratch_path(spark, "polygons"), mpoly="mpoly", srid=6668)
    back = spark.read.parquet(path).withColumn("mpoly", wkb.multipolygon_from_wkb("geometry"))
    return back.select("fid", (F.col("mpoly") == F.col("original")).alias("same"), F.length("geometry").cast("long").alias("nbytes"),
                       F.size(geom.polygon_vertices("mpoly")).cast("long").alias("vertices"), "bbox.xmin", "bbox.ymin", "bbox.xmax", "bbox.ymax")


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives landing in a folder ingested by a file-source stream (AvailableNow), per feature."""
    from ..sinks.partitioned import read_partitions_as_text
    from ..streaming.ingest import incremental_ingest as run

    root = scratch_path(spark, "stream")
    write_archives(spark, sf_dir, f"{root}/landing")
    run(spark, f"{root}/landing", f"{root}/table", f"{root}/_checkpoint")
    table = read_partitions_as_text(spark, f"{root}/table")
    value = lambda k: F.element_at("properties", F.lit(k))
    return table.select(value("fid").cast("long").alias("fid"), value("note").alias("note"), "road_type", "registration_date",
                        "source_mesh", F.size("geometry").alias("npts"), "srid")


def streaming_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meshes land one after the other; rows are flagged when a second mesh delivers their geometry."""
    from ..streaming.duplicates import run as flag

    root = scratch_path(spark, "landing")
    rows = fx.roads(spark, sf_dir).select("fid", "source_mesh", "line")
    # a mesh is one file, of row groups that many tasks read
    rows.repartition("source_mesh").write.option("parquet.block.size", 16 << 20).parquet(f"{root}/in")
    flag(spark, f"{root}/in", f"{root}/out", f"{root}/_checkpoint", rows.schema)
    return spark.read.schema("fid long, source_mesh string").parquet(f"{root}/out")
