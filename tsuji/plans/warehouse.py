"""Warehouse queries: normalise, stage -> typed transform, checks, upsert, parts and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geom
from ..operators import warehouse as wh
from ..operators.ids import dense_id
from ..session import current, scratch_path
from ..sinks import layout, parts
from ..sources import fixtures as fx

TYPED_COLS = ["fid", "road_type", "road_classification", "road_status", "width_category", "toll_category",
              "registration_date", "layer_order", "source_mesh", "secondary_mesh_code"]


def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery attributes renamed, mesh code parsed from the archive name."""
    raw = fx.raw_features(spark, sf_dir)
    out = wh.normalize_roads(raw, file_col="file_name")
    return out.drop("geometry", "file_name")


def stage_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage table -> checked, typed ``roads`` written and read back."""
    path = scratch_path(spark, "roads_typed")
    wh.transform(spark, fx.roads_stage(spark, sf_dir), path)
    typed = spark.read.parquet(current(spark, path))
    srid = geom.srid_of(typed, "line")
    return typed.select(*TYPED_COLS, F.size("line").alias("npts"), F.lit(srid).alias("srid"))


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL, foreign-key and primary-key violations of a typed table with bad rows in it."""
    return wh.constraint_violations(spark, wh.typed_roads(fx.flawed_stage(spark, sf_dir)))


def code_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: upsert of a change batch into the typed table keyed on ``fid``.

    Target: roads registered before 1997; changes: roads registered from 1996 on, re-surveyed as
    under construction (status 5). Overlapping years update, later ones insert, earlier ones stay.
    """
    roads = fx.roads(spark, sf_dir).select("fid", "road_status", "registration_date", "source_mesh")
    target = roads.where(F.col("registration_date") < F.lit("1997-01-01").cast("date"))
    changes = (roads.where(F.col("registration_date") >= F.lit("1996-01-01").cast("date"))
               .withColumn("road_status", F.lit(5).cast("smallint")))
    return wh.upsert(target, changes, ["fid"])


def nation_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 on a code table: nations of regions 0 to 2 renamed and those of region 4 added."""
    nation = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    changes = nation.where("n_regionkey <= 2 or n_regionkey = 4").withColumn("n_name", F.lower("n_name"))
    return wh.upsert(nation.where("n_regionkey < 4"), changes, ["n_nationkey"])


def merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw features -> one part per mesh -> merged output + spatially sorted
    output, both counted while written and reconciled; returns rows per mesh of the merged table."""
    root = scratch_path(spark, "merge")
    norm = wh.normalize_roads(fx.raw_features(spark, sf_dir), file_col="file_name").drop("file_name")
    parts.write_parts(norm, f"{root}/parts")
    paths = parts.part_paths(spark, f"{root}/parts")
    merged = parts.merge_parts(spark, paths, base_path=f"{root}/parts")
    n_merged = parts.write_counted(merged, f"{root}/merged", "merged")
    # geo metadata first: its union bbox also drives the spatial sort (no second bounds pass)
    meta = parts.write_geo_metadata(spark, geom.with_srid(spark.read.parquet(f"{root}/merged"), "geometry", 6668),
                                    f"{root}/merged_geo", geometry="geometry")
    bb = meta["columns"]["geometry"]["bbox"]
    sorted_path = f"{root}/merged_sorted"
    layout.write_covering_layout(spark.read.parquet(f"{root}/merged"), sorted_path, line="geometry",
                                 total=tuple(bb) if bb else None)
    n_sorted = spark.read.parquet(sorted_path).count()   # parquet answers from footers
    parts.reconcile({"merged": n_merged, "sorted": n_sorted})
    return spark.read.parquet(f"{root}/merged").groupBy("source_mesh").agg(F.count(F.lit(1)).alias("n"))


def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids 1..N in (source_mesh, fid) order without a single-task window."""
    r = fx.roads(spark, sf_dir).select("fid", "source_mesh")
    return dense_id(r, ["source_mesh", "fid"], out="id").select("fid", "id")
