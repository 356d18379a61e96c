"""The familiar-name facade over the Spark implementations."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji import api


def test_api_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="tsuji-test-", dir="/tmp")
    src = lines_df(spark, [("3622", [(139.7, 35.65), (139.72, 35.66)]), ("3622", [(139.8, 35.7), (139.81, 35.71)]),
                           ("3631", [(139.7, 35.65), (139.72, 35.66)])], "mesh string") \
        .withColumn("fid", F.monotonically_increasing_id()).withColumn("N13_002", F.lit("1")) \
        .withColumnRenamed("line", "geometry")
    from tsuji.sources import geojson
    geojson.write_mesh_archives(src, f"{root}/zips").count()
    assert api.convert_all(spark, f"{root}/zips", f"{root}/parts") == 3
    from tsuji.sinks import parts
    paths = parts.part_paths(spark, f"{root}/parts")
    assert api.merge_parts(spark, paths, f"{root}/merged", base_path=f"{root}/parts") == 3
    merged = spark.read.parquet(f"{root}/merged")
    assert api.find_cross_mesh_duplicates(merged).count() == 2
    assert api.count_invalid_geometries(merged) == 0
    lens = api.with_length(merged, "geometry").select("length_m").collect()
    assert all(r.length_m > 1000 for r in lens)
    n = api.normalize_roads(spark.createDataFrame([("2",)], "N13_002 string"), "3622").first()
    assert (n.road_type, n.source_mesh) == ("2", "3622")
    urls = spark.createDataFrame([(1, "http://h/a/f.zip"), (2, "http://h/b/f.zip"), (3, "http://h/g.zip")], "page_id long, url string")
    assert sorted(r.name for r in api.download_worklist(spark, urls, f"{root}/none").collect()) == ["f.zip", "g.zip"]


def test_archives_without_a_key_become_roads(spark):
    """Delivery attributes only, no key, one archive with nearly all rows."""
    from tsuji.session import current
    from tsuji.sinks import parts
    from tsuji.sources import geojson

    root = tempfile.mkdtemp(prefix="tsuji-test-", dir="/tmp")
    n = 3000
    src = (spark.range(n).select(
        F.when(F.col("id") < n - 5, "5339").otherwise("3622").alias("mesh"), F.col("id").alias("key"), F.lit("2024-09-01").alias("N13_001"),
        *[F.lit("1").alias(f"N13_00{i}") for i in (2, 3, 4, 6, 7)], F.lit("0").alias("N13_005"), F.lit("533946").alias("N13_008"),
        F.lit("kept").alias("remark"),
        F.expr("array(struct(139.0D + id / 1000 AS x, 35.0D AS y), struct(139.1D AS x, 35.5D AS y))").alias("geometry")))
    geojson.write_mesh_archives(src, f"{root}/zips", key="key", keep_key=False, features_per_archive=n).count()
    feats = api.read_mesh_zip(spark, f"{root}/zips")
    assert api.crs_epsg(feats) == 6668 and feats.where("remark = 'kept'").count() == n
    assert api.convert_all(spark, f"{root}/zips", f"{root}/parts") == n
    paths = parts.part_paths(spark, f"{root}/parts")
    assert api.load_parts(spark, paths, f"{root}/stage", base_path=f"{root}/parts") == n
    assert api.transform(spark, spark.read.parquet(current(spark, f"{root}/stage")), f"{root}/roads") == n
    roads = spark.read.parquet(current(spark, f"{root}/roads"))
    assert sorted(r.fid for r in roads.select("fid").collect()) == list(range(1, n + 1))
