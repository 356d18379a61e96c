"""Duplicate detection (U2, W6) and geometry-quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom


def cross_mesh_duplicates(df: DataFrame, geom_col: str = "line", mesh_col: str = "source_mesh") -> DataFrame:
    """Rows whose exact geometry occurs in two or more *different* meshes (detection only).

    Repeats inside one mesh do not count; null geometry never counts; empty in, empty out.
    Direction matters (the key is the vertex sequence), and so does the sign of a zero. Spark's
    grouping and hash functions treat 0.0 and -0.0 as equal, so the key is the geometry's text form,
    which writes every double in full and keeps the sign.

    Plan, sized for tables where geometry is the widest column:
    1. distinct meshes per *fingerprint* of the text form (xxhash64 + murmur3): the shuffle moves
       ~16 bytes + mesh code per row instead of the geometry, and map-side partial aggregation
       collapses a hot geometry before the exchange;
    2. rows whose fingerprint spans several meshes are the candidates (semi join on the
       fingerprint; the candidate set is broadcast by AQE only when its measured size allows);
    3. exact confirmation on the text form among the candidates only, so a fingerprint collision
       can never report a false duplicate.
    """
    text = F.col(geom_col).cast("string")
    fp = [F.xxhash64(text).alias("_h1"), F.hash(text).alias("_h2")]
    keyed = df.where(F.col(geom_col).isNotNull()).select("*", *fp)
    multi = (keyed.groupBy("_h1", "_h2").agg(F.count_distinct(mesh_col).alias("_m"))
             .where("_m > 1").select("_h1", "_h2"))
    cand = keyed.join(multi, ["_h1", "_h2"], "left_semi").withColumn("_text", text)
    shared = (cand.groupBy("_text").agg(F.count_distinct(mesh_col).alias("_m"))
              .where("_m > 1").select("_text"))
    return cand.join(shared, "_text", "left_semi").select(*df.columns)


def geometry_quality_by_mesh(df: DataFrame, geom_col: str = "line", mesh_col: str = "source_mesh",
                             polygon: bool = False) -> DataFrame:
    """Per mesh: rows and flagged geometries (missing OR empty OR invalid); report only, never repair."""
    status = geom.polygon_status(geom_col) if polygon else geom.line_status(geom_col)
    return (df.select(mesh_col, status.alias("_st"))
            .groupBy(mesh_col)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("_st") == "missing").alias("n_missing"),
                 F.count_if(F.col("_st") == "empty").alias("n_empty"),
                 F.count_if(F.col("_st") == "invalid").alias("n_invalid"),
                 F.count_if(F.col("_st") != "ok").alias("n_flagged")))


def count_invalid(df: DataFrame, geom_col: str = "geometry", polygon: bool = False) -> int:
    """Total flagged geometries (scalar)."""
    status = geom.polygon_status(geom_col) if polygon else geom.line_status(geom_col)
    return df.where(status != "ok").count()
