"""Bounding-box search (F1-F4) and the total-bounds aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import geom

Box = tuple[float, float, float, float]

# Fixed value: the search window of the benchmark queries (around Tokyo station), lon/lat.
TOKYO_STATION_BOX: Box = (139.75, 35.66, 139.79, 35.70)


def with_bbox(df: DataFrame, line: str = "line", out: str = "bbox") -> DataFrame:
    """Attach the per-row covering column."""
    return df.withColumn(out, geom.bounds(line))


def bbox_overlap(df: DataFrame, box: Box, line: str = "line") -> DataFrame:
    """Rows whose computed bbox overlaps the envelope (``geometry && envelope``, F2)."""
    b = geom.bounds(line)
    return df.where(geom.bbox_covers(b, box))


def covering_candidates(df: DataFrame, box: Box, bbox: str = "bbox") -> DataFrame:
    """Rows whose stored covering column overlaps the box (F3); prunes row groups by statistics."""
    return df.where(geom.bbox_covers(bbox, box))


def intersecting(df: DataFrame, box: Box, line: str = "line", bbox: str | None = "bbox") -> DataFrame:
    """Exact ``ST_Intersects(line, envelope)`` (F1). With a covering column the cheap predicate runs
    first so the scan can skip data (F4); without one the exact test runs on every row."""
    if bbox and bbox in df.columns:
        return df.where(geom.intersects_envelope(bbox, line, box))
    return df.where(geom.intersects_box(line, box))


def total_bounds(df: DataFrame, bbox: str = "bbox") -> DataFrame:
    """Union bbox of a table: one global partial/final aggregate."""
    return df.agg(F.min(f"{bbox}.xmin").alias("xmin"), F.min(f"{bbox}.ymin").alias("ymin"),
                  F.max(f"{bbox}.xmax").alias("xmax"), F.max(f"{bbox}.ymax").alias("ymax"),
                  F.count(F.lit(1)).alias("n"))


def total_bounds_row(df: DataFrame, bbox: str = "bbox") -> Row:
    """The union bbox as a driver-side row of four numbers (a scalar result, not data)."""
    return total_bounds(df, bbox).first()
