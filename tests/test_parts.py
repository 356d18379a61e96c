"""Merging many parts (K2): footers in one job, the same errors as part by part."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tsuji.session import scratch_path
from tsuji.sinks import parts


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def write(root, name, table):
    os.makedirs(f"{root}/{name}", exist_ok=True)
    pq.write_table(table, f"{root}/{name}/part-0.parquet")
    return f"{root}/{name}"


def test_many_parts_are_one_job(spark):
    root = local(scratch_path(spark, "many"))
    paths = [write(root, f"mesh={i:05d}", pa.table({"a": pa.array([i], pa.int32() if i % 3 else pa.int64()), "b": ["x"]})) for i in range(1000)]
    sc = spark.sparkContext
    sc.setJobGroup("schemas", "schemas")
    schemas = parts.part_schemas(spark, paths)
    jobs = len(sc.statusTracker().getJobIdsForGroup("schemas"))
    sc.setJobGroup("other", "other")
    assert jobs <= 6 and len(schemas) == 1000 and all(len(s) == 1 for s in schemas.values())    # not one per part
    merged = parts.merge_parts(spark, paths, base_path=root)
    assert merged.dtypes == [("a", "bigint"), ("b", "string"), ("mesh", "string")]
    row = merged.agg({"a": "sum", "mesh": "max"}).first()
    assert row["sum(a)"] == sum(range(1000)) and row["max(mesh)"] == "00999"


def test_wrong_fields_and_types_are_named(spark):
    root = local(scratch_path(spark, "bad"))
    good = pa.table({"a": pa.array([1], pa.int32()), "b": ["x"]})
    one, two = write(root, "m=1", good), write(root, "m=2", pa.table({"b": ["x"], "a": pa.array([1], pa.int32())}))
    with pytest.raises(ValueError, match=r"m=2 has fields \['b', 'a', 'm'\], expected \['a', 'b', 'm'\]"):
        parts.merge_parts(spark, [one, two], base_path=root)
    three = write(root, "m=3", good)
    pq.write_table(pa.table({"a": pa.array([2.0]), "b": ["y"]}), f"{three}/part-1.parquet")
    with pytest.raises(ValueError, match="m=3 has files of different types"):
        parts.merge_parts(spark, [one, three], base_path=root)
    four = write(root, "m=4", pa.table({"a": pa.array([1.5]), "b": ["z"]}))
    with pytest.raises(Exception, match="unsafe cast of a"):
        parts.merge_parts(spark, [one, four], base_path=root).collect()
    spark.range(2).selectExpr("cast(id as int) a", "'s' b").write.parquet(f"{root}/m=5")
    both = parts.merge_parts(spark, [one, f"{root}/m=5"], base_path=root)
    assert sorted((r.a, r.b, r.m) for r in both.collect()) == [(0, "s", "5"), (1, "s", "5"), (1, "x", "1")]
