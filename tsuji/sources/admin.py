"""Administrative-area polygons: read, normalise to multipolygons, number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom
from ..operators.ids import dense_id

# Source attribute -> admin_area column (code, prefecture name, city name).
ADMIN_FIELD_MAP = {"N03_007": "admin_code", "N03_001": "pref_name", "N03_004": "city_name"}
TARGET_SRID = 4326


def normalize_admin(src: DataFrame, geom_type: str = "geom_type", polygon: str = "rings",
                    multi: str = "multi_rings", src_srid: int | None = None) -> DataFrame:
    """Keep only the three attributes (renamed), move to EPSG:4326, promote Polygon to a
    1-element MultiPolygon, and drop rows whose geometry is missing or empty."""
    srid = src_srid if src_srid is not None else (geom.srid_of(src, polygon) or TARGET_SRID)
    mp = geom.transform_crs(geom.to_multipolygon(geom_type, polygon, multi), srid, TARGET_SRID)
    out = src.select(*[F.col(k).alias(v) for k, v in ADMIN_FIELD_MAP.items()], mp.alias("mpoly"))
    out = out.where(F.col("mpoly").isNotNull() & (F.size("mpoly") > 0))
    return geom.with_srid(out, "mpoly", TARGET_SRID)


def load_admin(src: DataFrame, **kw) -> DataFrame:
    """``admin_area`` as loaded after truncate + restart identity: gid = 1..N in a stable order.
    Rows breaking the NOT NULL columns stop the load."""
    norm = normalize_admin(src, **kw)
    bad = check_admin_required(norm).count()
    if bad:
        raise ValueError(f"admin_area: {bad} rows with a missing admin_code, pref_name or geometry")
    norm = norm.withColumn("_tie", F.xxhash64(F.to_json("mpoly")))
    return dense_id(norm, ["admin_code", "pref_name", "_tie"], out="gid").drop("_tie").select(
        "gid", "admin_code", "pref_name", "city_name", "mpoly")


def check_admin_required(admin: DataFrame) -> DataFrame:
    """Rows violating the NOT NULL columns of admin_area (empty frame when clean)."""
    return admin.where(F.col("admin_code").isNull() | F.col("pref_name").isNull() | F.col("mpoly").isNull())
