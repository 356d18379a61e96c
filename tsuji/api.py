"""The pipeline's public operations under their familiar names, as Spark functions.

Each delegates to the Spark implementation in the package; inputs and outputs are DataFrames
(or a count where the operation reports one).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geom, text
from .operators import quality, transfer, warehouse
from .sinks import parts
from .sources import fetch, geojson

log = logging.getLogger(__name__)

EXPECTED_EPSG = 6668
SOURCE_MESH_COLUMN = warehouse.SOURCE_MESH
MAX_WARNINGS = 100       # meshes named in the log


def normalize_roads(df: DataFrame, mesh_code: str) -> DataFrame:
    """Rename the delivery attributes, keep unknown columns, tag every row with ``mesh_code``."""
    return warehouse.normalize_roads(df, mesh=mesh_code)


def count_invalid_geometries(df: DataFrame, geometry: str = "geometry", polygon: bool = False) -> int:
    """Missing + empty + invalid geometries (reported, never repaired)."""
    return quality.count_invalid(df, geometry, polygon)


def crs_epsg(df: DataFrame, geometry: str = "geometry") -> int | None:
    return geom.srid_of(df, geometry)


def mesh_code_from_path(name) -> Column:
    """Mesh code of an archive name (error when absent)."""
    return text.mesh_code_from_name(name)


def read_mesh_zip(spark: SparkSession, path: str) -> DataFrame:
    """Features of one archive or of every archive below a folder."""
    return geojson.read_mesh_archives(spark, path, glob="*.zip")


def convert_all(spark: SparkSession, archives: str, parts_dir: str) -> int:
    """Archives -> normalised features -> one part folder per mesh. Returns the feature count.

    The archives are read once; the report per mesh (CRS and geometry quality) is one aggregate over
    the written features."""
    feats = warehouse.normalize_roads(geojson.read_mesh_archives(spark, archives), file_col="file_name")
    report = (feats.select(SOURCE_MESH_COLUMN, "srid", geom.line_status("geometry").alias("status"))
              .groupBy(SOURCE_MESH_COLUMN)
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != "ok").alias("flagged"),
                   F.count_if(F.col("srid") != EXPECTED_EPSG).alias("other_crs")))
    report = report.cache()                       # a row per mesh
    for r in report.where("flagged > 0 or other_crs > 0").orderBy(SOURCE_MESH_COLUMN).limit(MAX_WARNINGS).collect():
        log.warning("mesh %s: %d geometries missing, empty or invalid (kept), %d features not in EPSG:%s",
                    r[SOURCE_MESH_COLUMN], r["flagged"], r["other_crs"], EXPECTED_EPSG)
    total = report.agg(F.sum("n")).first()[0] or 0
    report.unpersist()
    parts.write_parts(feats.drop("file_name", "member", "feature_no", "properties", "geom_type", "rings", "multi_rings", "srid"), parts_dir)
    return total


def find_cross_mesh_duplicates(df: DataFrame, mesh_col: str = SOURCE_MESH_COLUMN, geometry: str = "geometry") -> DataFrame:
    return quality.cross_mesh_duplicates(df, geometry, mesh_col)


def merge_parts(spark: SparkSession, part_paths: Sequence[str], output_path: str, base_path: str | None = None) -> int:
    """Parts merged under the first part's schema into ``output_path``; returns the rows written."""
    return parts.write_counted(parts.merge_parts(spark, part_paths, base_path), output_path, "merge_parts")


def load_parts(spark: SparkSession, part_paths: Sequence[str], table_path: str, base_path: str | None = None) -> int:
    """Truncate + append of the parts into the stage table; returns the rows loaded."""
    return parts.load_stage(spark, part_paths, table_path, base_path)


def transform(spark: SparkSession, stage: DataFrame, target_path: str) -> int:
    """Stage -> checked, typed table; returns the rows written."""
    return warehouse.transform(spark, stage, target_path)


def parse_http_message(message) -> Column:
    return text.parse_http_message(message)


def summarize_transfer(messages: DataFrame, message: str = "message", seq: str = "seq",
                       by: list[str] | None = None) -> DataFrame:
    """n_requests, n_get, get_bytes, full_size, fraction (per ``by`` group or overall)."""
    return transfer.summarize_transfer(transfer.parse_log(messages, message), by=by, seq=seq)


def filename_from_url(url) -> Column:
    return text.url_file_name(url)


def download_worklist(spark: SparkSession, urls: DataFrame, dest_dir: str, url: str = "url",
                      order: str = "page_id") -> DataFrame:
    """URLs still to fetch into ``dest_dir`` (existing non-empty files are skipped)."""
    return fetch.worklist(urls, fetch.listing(spark, dest_dir), url, order)


def envelope(x0: float, y0: float, x1: float, y1: float) -> Column:
    return geom.envelope(x0, y0, x1, y1)


def with_length(df: DataFrame, line: str = "line", spheroid: bool = True, out: str = "length_m") -> DataFrame:
    """Geodesic length per row (spheroid by default, like a geography length)."""
    from .functions import geodesy

    return df.withColumn(out, (geodesy.length_spheroid if spheroid else geodesy.length_sphere)(F.col(line)))
